"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton of all test items answers, while a document streams by word after word, how long the
match that ends here is.  A word is hit when it lies inside an occurrence of a window: ``size``
consecutive words of one item, or a whole item of fewer words.

The items are the stated query set.  Tasks cut them into blocks of at most ``block_words`` words, an
item that is longer into pieces that overlap by ``size - 1`` words, and store the blocks.  The driver
hands out the texts of one block at a time, never all; each worker builds the automaton of the block it
works on (two states a word).  Documents stream past block after block: what was found is carried
along with the row and stored between two blocks, so documents are never shuffled.

Defined cases: a null text or item has no words; an item that repeats, or has a null id, hits all
the same, and the ids that are reported are distinct and not null; an empty benchmark hits
nothing; rows that repeat are treated alike; other columns are carried along or ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import column, in_small_batches, keep, whole_row

#: A word counts once more for every so many bytes, so that a block is bounded in bytes as well.
_WORD_BYTES = 64

#: Bytes of words keep their value, A-Z become a-z, all others separate words.
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORD).split() if text else []


def word_bounds(text: str) -> list[tuple[int, int]]:
    """Start and end of every word in the UTF-8 bytes of the text."""
    data, bounds, at = text.encode().translate(_WORD), [], 0
    for word in data.split():
        at = data.index(word, at)
        bounds.append((at, at := at + len(word)))
    return bounds


class Automaton:
    """Generalised suffix automaton of the items, with the windows' owners at its states."""

    def __init__(self, items: Iterable[tuple[int | None, str | None]], size: int):
        self.size, self.go, self.link, self.longest = size, [{}], [-1], [0]
        listed = [(k, words_of(text)) for k, text in items]
        listed = [(k, words) for k, words in listed if words]
        for _, words in listed:
            last = 0
            for word in words:
                last = self._extend(last, word)
        n = len(self.go)
        # The shallowest state on the way up whose strings reach the window size; -1: none.
        self.top = [-1] * n
        order = sorted(range(1, n), key=self.longest.__getitem__)
        for v in order:
            if self.longest[v] >= size:
                above = self.top[self.link[v]]
                self.top[v] = above if above >= 0 else v
        self.owners: dict[int, set[int | None]] = {}
        short: dict[int, list[tuple[int, int | None]]] = {}
        for k, words in listed:
            state = 0
            if len(words) < size:
                for word in words:
                    state = self.go[state][word]
                short.setdefault(state, []).append((len(words), k))
            else:
                for i, word in enumerate(words, 1):
                    state = self.go[state][word]  # the whole prefix occurs
                    if i >= size:
                        self.owners.setdefault(self.at_size(state), set()).add(k)
        # Short items that end where a state ends: its own and those of the states above.
        self.short: list[tuple] = [()] * n
        for v in order:
            self.short[v] = self.short[self.link[v]] + tuple(short.get(v, ()))

    def _extend(self, last: int, word: bytes) -> int:
        go, link, longest = self.go, self.link, self.longest
        q = go[last].get(word)
        if q is not None:
            return q if longest[q] == longest[last] + 1 else self._clone(last, word, q)
        new = len(go)
        go.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        p = last
        while p >= 0 and word not in go[p]:
            go[p][word] = new
            p = link[p]
        if p >= 0:
            q = go[p][word]
            link[new] = q if longest[q] == longest[p] + 1 else self._clone(p, word, q)
        return new

    def _clone(self, p: int, word: bytes, q: int) -> int:
        go, link, longest = self.go, self.link, self.longest
        copy = len(go)
        go.append(dict(go[q]))
        link.append(link[q])
        longest.append(longest[p] + 1)
        link[q] = copy
        while p >= 0 and go[p].get(word) == q:
            go[p][word] = copy
            p = link[p]
        return copy

    def at_size(self, state: int) -> int:
        return self.top[state]

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set[int | None]]:
        """Merged spans of hit words, and the items with an occurring window."""
        go, link, longest, short, top, size = self.go, self.link, self.longest, self.short, self.top, self.size
        spans: list[list[int]] = []
        seen: set[int] = set()
        items: set[int | None] = set()
        root = go[0]
        state = length = 0
        for i, word in enumerate(words, 1):
            after = go[state].get(word)
            if after is not None:
                length += 1
            elif not state:
                continue
            else:
                while True:
                    state = link[state]
                    if state <= 0:
                        after, length = root.get(word, 0), 0
                        if after:
                            length = 1
                        break
                    after = go[state].get(word)
                    if after is not None:
                        length = longest[state] + 1
                        break
            state = after
            start = i
            if length >= size:
                seen.add(top[state])
                start = i - size
            if short[state]:
                for n, item in short[state]:
                    if n <= length:
                        items.add(item)
                        start = min(start, i - n)
            if start < i:
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, i])
        for v in seen:
            items |= self.owners[v]
        return spans, items


def pieces_of(text: str | None, size: int, most: int) -> Iterator[tuple[int, str]]:
    """(weight, text) of pieces of an item, of at most about ``most`` in weight, with the same windows as the item."""
    words = words_of(text)
    weights = [1 + len(w) // _WORD_BYTES for w in words]
    at = 0
    while words:
        # A piece holds one window at least, however long its words are.
        end, weight = min(at + size, len(words)), sum(weights[at : at + size])
        while end < len(words) and weight + weights[end] <= most:
            weight, end = weight + weights[end], end + 1
        yield weight, b" ".join(words[at:end]).decode()
        if end == len(words):
            return
        at = end - size + 1


def blocks(benchmark: DataFrame, item_id: str, text: str, size: int, block_words: int) -> DataFrame:
    """Stored blocks of items: block (its name), ids, texts; at most ``block_words`` words each, packed in tasks."""
    items = benchmark.select(column(item_id).cast("long").alias("id"), column(text).alias("text")).distinct()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str]] = []
        full = 0

        def block() -> pa.RecordBatch:
            lists = [pa.array([[k for k, _ in held]], pa.list_(pa.int64())), pa.array([[t for _, t in held]], pa.list_(pa.string()))]
            return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), *lists], ["block", "ids", "texts"])

        for batch in batches:
            for k, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                for weight, piece in pieces_of(text, size, block_words):
                    if held and full + weight > block_words:
                        yield block()
                        held, full = [], 0
                    held.append((k, piece))
                    full += weight
        if held:
            yield block()

    # A task packs some 16 bytes for each word of a block, so that few blocks stay partly filled.
    n_bytes = benchmark.agg(F.sum(F.octet_length(column(text)))).first()[0] or 0
    items = items.coalesce(1 + n_bytes // (16 * block_words))
    return keep(in_small_batches(items).mapInArrow(pack, "block string, ids array<bigint>, texts array<string>"), "benchmark-blocks")


class Block:
    """One block on its way to the workers: the texts are broadcast, the automaton is built where it is used."""

    def __init__(self, spark, items: list[tuple[int | None, str]], size: int):
        self.shared, self.size, self.name = spark.sparkContext.broadcast(items), size, uuid.uuid4().hex

    def automaton(self) -> Automaton:
        # One automaton per worker; the next block takes its place.
        if self.name not in _BUILT:
            _BUILT.clear()
            _BUILT[self.name] = Automaton(self.shared.value, self.size)
        return _BUILT[self.name]


_BUILT: dict[str, Automaton] = {}


def _handed_out(packed: DataFrame, size: int) -> Iterator[tuple[Block, bool]]:
    """The blocks one by one, each with whether it is the last; one empty block when there are none.

    A block that is not the last is taken back from the workers when the next one is asked for, so
    its results have to be stored by then.
    """
    names = [r["block"] for r in packed.select("block").collect()]
    for name in names or [None]:
        row = packed.where(F.col("block") == name).first() if names else None
        items = list(zip(row["ids"], row["texts"])) if row else []
        block, last = Block(packed.sparkSession, items, size), not names or name == names[-1]
        yield block, last
        if not last:
            block.shared.unpersist()


def _joined(spans: Iterable[tuple[int, int]]) -> list[list[int]]:
    """Sorted spans, joined where they touch or overlap."""
    out: list[list[int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return out


_SPANS = pa.list_(pa.struct([("a", pa.int64()), ("z", pa.int64())]))


def _scanned(rows: DataFrame, packed: DataFrame, size: int) -> DataFrame:
    """``rows`` (any columns and ``text``) plus n_words, spans and items over all blocks."""
    carried = [n for n in rows.columns if n != "text"]
    nothing = {"n_words": "cast(0 as bigint)", "spans": "cast(array() as array<struct<a:bigint,z:bigint>>)", "items": "cast(array() as array<bigint>)"}
    rows = rows.select(*carried, "text", *[F.expr(e).alias(n) for n, e in nothing.items()])
    schema = rows.schema
    for block, last in _handed_out(packed, size):

        def run(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            automaton = block.automaton()
            for batch in batches:
                n_words, spans, items = [], [], []
                before = zip(*(batch.column(n).to_pylist() for n in ("text", "spans", "items")))
                for text, old, known in before:
                    words = words_of(text)
                    hit, found = automaton.scan(words)
                    if old:
                        hit = _joined([*map(tuple, hit), *((s["a"], s["z"]) for s in old)])
                    n_words.append(len(words))
                    spans.append([{"a": a, "z": z} for a, z in hit])
                    items.append(sorted({k for k in found if k is not None}.union(known)))
                own = [pa.array(n_words, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column(n) for n in [*carried, "text"]] + own, [*carried, "text", "n_words", "spans", "items"])

        rows = in_small_batches(rows).mapInArrow(run, schema)
        if not last:
            rows = keep(rows, "benchmark-spans")
    return rows


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
    item_text: str = "text", size: int = 10, block_words: int = 100_000,
) -> DataFrame:
    """doc_id, text_key, n_words, spans (of hit words, end exclusive), items (ids, distinct) per row."""
    rows = docs.select(column(doc_id).cast("long").alias("doc_id"), F.xxhash64(column(text)).alias("text_key"), column(text).alias("text"))
    return _scanned(rows, blocks(benchmark, item_id, item_text, size, block_words), size).drop("text")


def without(text: str, hit: list[list[int]]) -> str:
    """The text without the hit words; what stood around a removed span is joined by a line break."""
    bounds, data, at, rest = word_bounds(text), text.encode(), 0, []
    for a, z in hit:
        rest.append(data[at : bounds[a][0]])
        at = bounds[z - 1][1]
    rest.append(data[at:])
    return b"\n".join(rest).decode()


def covered(hit: list[list[int]], n_words: int, max_coverage: float) -> bool:
    return sum(z - a for a, z in hit) > max_coverage * n_words


def cut(text: str, automata: list[Automaton], max_coverage: float) -> str | None:
    """The text without hit words; None when more than ``max_coverage`` of its words are hit.

    Joining what stood around a span can form a new window, so the rest is looked at again until
    nothing is hit.
    """
    first = True
    while True:
        words = words_of(text)
        hit = _joined((a, z) for automaton in automata for a, z in automaton.scan(words)[0])
        if not hit:
            return text
        if first and covered(hit, len(words), max_coverage):
            return None
        first = False
        text = without(text, hit)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    size: int = 10, max_coverage: float = 0.5, block_words: int = 100_000,
) -> DataFrame:
    """The documents with contaminated spans removed; those hit in more than ``max_coverage`` of their words go.

    A text without a hit comes back byte for byte.  With one block a task looks at a text until nothing
    is hit.  With several, each round takes the spans of all blocks, cuts them, and sends only the
    texts that it cut to the next round; the result is the same.
    """
    packed = blocks(benchmark, item_id, item_text, size, block_words)
    rows = docs.select(whole_row(docs.drop(text)).alias("row"), column(text).alias("text"))
    if packed.limit(2).count() < 2:
        cleaned = _cut_at_once(rows, packed, size, max_coverage)
    else:
        cleaned = _cut_in_rounds(rows, packed, size, max_coverage)
    return cleaned.select(*[F.col("text").alias(n) if n == text else F.col("row").getField(n).alias(n) for n in docs.columns])


def _cut_at_once(rows: DataFrame, packed: DataFrame, size: int, max_coverage: float) -> DataFrame:
    block, _ = next(_handed_out(packed, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [block.automaton()]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rest = [t if not t else cut(t, automata, max_coverage) for t in texts]
            stays = pa.array([t is None or r is not None for t, r in zip(texts, rest)])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(rest, pa.string())], ["row", "text"]).filter(stays)

    return in_small_batches(rows).mapInArrow(run, rows.schema)


def _cut_in_rounds(rows: DataFrame, packed: DataFrame, size: int, max_coverage: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch], first: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, stays = [], []
            for text, n, spans in zip(*(batch.column(c).to_pylist() for c in ("text", "n_words", "spans"))):
                hit = [[s["a"], s["z"]] for s in spans]
                stays.append(not (first and hit and covered(hit, n, max_coverage)))
                texts.append(without(text, hit) if hit and stays[-1] else text)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"]).filter(pa.array(stays))

    done, first = None, True
    while True:
        found = keep(_scanned(rows, packed, size), "benchmark-round")
        clean = found.where(F.size("spans") == 0).select("row", "text")
        done = clean if done is None else done.unionByName(clean)
        hit = found.where(F.size("spans") > 0)
        if hit.isEmpty():
            return done
        rows = keep(in_small_batches(hit.select("row", "text", "n_words", "spans")).mapInArrow(lambda b, f=first: run(b, f), rows.schema), "benchmark-rest")
        first = False
