"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

Segmentation merges pairs of the best score first, from an agenda.  With dropout a candidate
merge that comes up is skipped when a keyed hash of it falls below ``dropout``, which gives
other, equally valid segmentations of the same text.  The key is made of the seed, the document and the
number of the chunk in it, and the candidate adds its place in the chunk and its length; so every
occurrence of a word draws for itself, and always gets the same pieces again, on any partitioning.

The merges of a chunk without dropout are remembered.  An occurrence that skips none of them has the
remembered pieces, as what is not merged in the end does not matter; all other occurrences run
their own agenda, side by side.

Chunks are a run of blanks with the text up to the next blank: no piece goes on after it.
Characters that no longer piece contains are cut off as well.

Defined cases: a null text has null pieces and decodes to null; an empty text has no pieces; a
character outside the vocabulary, U+2581 included, becomes its UTF-8 bytes; repeated rows get the
same pieces; other columns are ignored or carried along.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import column, in_small_batches, whole_row

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
_M = (1 << 64) - 1
#: Factor of the hash of a pair, odd.
_FIRST = np.uint64(0x9E3779B97F4A7C15)
#: Chunks a worker remembers, and chunks it looks up at once.
REMEMBERED, CHUNKS_AT_ONCE = 300_000, 60_000
_CUT = re.compile("(?<=[^ ]) ")
#: Rows of one batch of results.
ROWS_OUT = 500


class Pieces:
    """A merge-type piece model: merges by rank, ids and the bytes each id stands for."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        plain = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        named = {i: model.id_to_piece(i) for i in plain}
        self.ids = {p: i for i, p in named.items()}
        self.order = {p: -model.get_score(i) for i, p in named.items() if len(p) > 1}
        self.bytes = [0] * 256
        self.meaning = [b""] * len(every)
        for i in every:
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[1:-1], 16)
                self.bytes[value], self.meaning[i] = i, bytes([value])
        for i, p in named.items():
            self.meaning[i] = p.replace(BLANK, " ").encode()
        if not all(self.bytes):
            raise ValueError(f"{path} has no piece for every byte, so it cannot decode losslessly")
        if any(BLANK in p.lstrip(BLANK) for p in named.values()):
            raise ValueError(f"{path} has pieces that go on after a blank")
        self.chunks = re.compile(self._pattern()).findall
        self._number_symbols()

    def _pattern(self) -> str:
        """Chunks: blanks with a run of letters or of other characters, unless a piece mixes the two."""
        single = re.escape("".join(c for c in map(chr, range(1, 33)) if c != " " and not any(c in p for p in self.order)) + BLANK)
        word = re.compile(r"[^\W_]").match
        pairs = {p[i : i + 2] for p in self.order for i in range(len(p) - 1)}
        mixed = [x for x in pairs if BLANK not in x and bool(word(x[0])) != bool(word(x[1]))]
        # Letters that stand beside others in a piece are counted as others, if that settles it.
        odd = {c for x in mixed for c in x if word(c)}
        if any((x[0] in odd) != (x[1] in odd) and word(x[0]) and word(x[1]) for x in pairs):
            return f"[{single}]| *[^ {single}]+| +"
        out = re.escape("".join(sorted(odd)))
        return rf"[{single}]| *[^\W_{out}{single}]+| *(?:[\W_{out}](?<![ {single}]))+| +"

    def _number_symbols(self) -> None:
        """Symbols are all pieces; a pair of symbols that makes a piece is a merge."""
        self.symbols = {p: k for k, p in enumerate(self.ids)}
        self.symbol_ids = np.array(list(self.ids.values()), np.int64)
        scores = {v: k for k, v in enumerate(sorted(set(self.order.values())))}
        width, merges = len(self.symbols) + 1, []
        for piece, score in self.order.items():
            for cut in range(1, len(piece)):
                left, right = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if left is not None and right is not None:
                    merges.append((left * width + right, scores[score], self.symbols[piece]))
        merges.sort()
        self.width = width
        self.pairs, self.pair_rank, self.pair_symbol = (np.array(x, np.int64) for x in zip(*merges))
        self._place_pairs()

    def _place_pairs(self, bits: int = 20) -> None:
        """Two hash tables over the pairs; what meets another pair in the first one is in the second."""
        self.shift = np.uint64(64 - bits)
        keys = self.pairs.astype(np.uint64)
        at = (keys * _FIRST) >> self.shift
        self.first = np.zeros(1 << bits, np.int32)
        self.first[at] = np.arange(len(keys))
        others = np.flatnonzero(self.first[at] != np.arange(len(keys)))
        self.shared = np.zeros(1 << bits, bool)
        self.shared[at[others]] = True
        factor = int(_FIRST)
        while True:
            factor = (5 * factor + 2) & _M
            self.factor = np.uint64(factor)
            spot = (keys[others] * self.factor) >> self.shift
            if len(np.unique(spot)) == len(others):
                break
        self.second = np.zeros(1 << bits, np.int32)
        self.second[spot] = others

    def find(self, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of every pair of symbols among the merges, and whether it is one."""
        keys = pair.astype(np.uint64)
        spot = (keys * _FIRST) >> self.shift
        found = self.first[spot]
        good = self.pairs[found] == pair
        again = np.flatnonzero(self.shared[spot] & ~good)
        if len(again):
            found[again] = self.second[(keys[again] * self.factor) >> self.shift]
            good[again] = self.pairs[found[again]] == pair[again]
        return found, good


def _candidate(place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Place and length of a candidate in one number."""
    return place.astype(np.uint64) << np.uint64(32) | size.astype(np.uint64)


def _skipped(key: np.ndarray, candidate: np.ndarray, limit: int) -> np.ndarray:
    """Whether the keyed hash of a candidate falls below the limit."""
    h = key ^ candidate
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h < np.uint64(limit)


_NEVER = np.int64(1 << 62)


Merges = tuple[np.ndarray, np.ndarray, np.ndarray]


def merged(pieces: Pieces, chunks: list[str], keys: np.ndarray, limit: int) -> tuple[list[bytes], Merges]:
    """Packed ids of every chunk after all merges of its agenda, and the merges (chunk, place, length).

    The chunks go side by side: in each turn every chunk merges its best candidate, the leftmost of
    the best score.  Whether a candidate is skipped depends only on the key of the chunk and its
    place and length, so skipping it for good is the same as skipping it when it comes up.
    """
    lengths = np.array([len(c) for c in chunks])
    letters = "".join(chunks).replace(" ", BLANK)
    distinct = {c: pieces.symbols.get(c, -1) for c in set(letters)}
    symbol = np.array([distinct[c] for c in letters], np.int64)
    n = len(symbol)
    starts = np.cumsum(lengths) - lengths
    chunk = np.repeat(np.arange(len(chunks)), lengths)
    slot = np.arange(n)
    after = np.where(slot + 1 < np.repeat(starts + lengths, lengths), slot + 1, -1)
    before = np.where(slot > np.repeat(starts, lengths), slot - 1, -1)
    size, alive = np.ones(n, np.int64), np.ones(n, bool)
    best, target = np.full(n, _NEVER), np.zeros(n, np.int64)
    key_of = np.repeat(keys.astype(np.uint64), lengths) if limit else None
    place_of = slot - np.repeat(starts, lengths)

    def look(at: np.ndarray) -> None:
        """Candidates of the slots ``at`` with what follows them."""
        right = after[at]
        fits = (right >= 0) & (symbol[at] >= 0)
        fits[fits] = symbol[right[fits]] >= 0
        best[at[~fits]] = _NEVER
        at, right = at[fits], right[fits]
        pair = symbol[at] * pieces.width + symbol[right]
        found, good = pieces.find(pair)
        best[at[~good]] = _NEVER
        at, right, found = at[good], right[good], found[good]
        rank = pieces.pair_rank[found] << 32 | at
        if limit:
            rank[_skipped(key_of[at], _candidate(place_of[at], size[at] + size[right]), limit)] = _NEVER
        best[at] = rank
        target[at] = pieces.pair_symbol[found]

    look(slot)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    active = np.arange(len(chunks))
    where, bounds = slot, starts  # slots of the chunks that still merge, and where each of them begins
    while len(active):
        least = np.minimum.reduceat(best[where], bounds)
        going = least < _NEVER
        if 2 * going.sum() < len(active) or not going.all() and len(active) < 1000:
            active = active[going]
            if not len(active):
                break
            many = lengths[active]
            bounds = np.cumsum(many) - many
            where = np.repeat(starts[active] - bounds, many) + np.arange(many.sum())
            least = least[going]
        else:
            least = least[going]
        left = least & 0xFFFFFFFF
        gone = after[left]
        symbol[left] = target[left]
        size[left] += size[gone]
        done.append((left, size[left]))
        alive[gone], best[gone] = False, _NEVER
        after[left] = after[gone]
        follows = after[left]
        before[follows[follows >= 0]] = left[follows >= 0]
        look(left)
        leads = before[left]
        look(leads[leads >= 0])
    held = np.flatnonzero(alive)
    ids = np.where(symbol[held] >= 0, pieces.symbol_ids[symbol[held]], -1)
    many = np.ones(len(held), np.int64)
    unknown = np.flatnonzero(ids < 0)
    if len(unknown):
        # A character without a piece becomes its bytes.
        spelled = [[pieces.bytes[b] for b in letters[c].encode()] for c in held[unknown].tolist()]
        many[unknown] = [len(x) for x in spelled]
        at = np.cumsum(many) - many
        ids = np.repeat(ids, many)
        for k, x in zip(at[unknown].tolist(), spelled):
            ids[k : k + len(x)] = x
    ends = np.cumsum(np.bincount(chunk[held], many, len(chunks)).astype(np.int64)) * 4
    packed = ids.astype("<i4").tobytes()
    at, length = (np.concatenate([d[k] for d in done] or [np.empty(0, np.int64)]) for k in (0, 1))
    return [packed[a:z] for a, z in zip([0, *ends.tolist()], ends.tolist())], (chunk[at], place_of[at], length)


class _Known:
    """Pieces and merges of chunks without dropout."""

    def __init__(self) -> None:
        self.slots: dict[str, int] = {}
        self.packed: list[bytes] = []
        self.starts = np.zeros(1, np.int64)
        self.candidates = np.empty(0, np.uint64)

    def learn(self, pieces: Pieces, chunks: list[str]) -> None:
        # U+2581 in a text is no blank; such a chunk stands alone.
        plain = [c for c in chunks if c != BLANK]
        packed, (chunk, place, length) = merged(pieces, plain, np.zeros(len(plain), np.uint64), 0) if plain else ([], (np.empty(0, np.int64),) * 3)
        counts = np.bincount(chunk, minlength=len(plain))
        if len(plain) < len(chunks):
            plain, counts = [*plain, BLANK], np.r_[counts, 0]
            packed = [*packed, np.array([pieces.bytes[b] for b in BLANK.encode()], "<i4").tobytes()]
        order = np.argsort(chunk, kind="stable")
        self.candidates = np.r_[self.candidates, _candidate(place[order], length[order])]
        self.starts = np.r_[self.starts, self.starts[-1] + np.cumsum(counts)]
        self.slots.update(zip(plain, range(len(self.packed), len(self.packed) + len(plain))))
        self.packed += packed


def _mixed(values: np.ndarray) -> np.ndarray:
    """Finalised 64-bit hashes."""
    values = (values ^ values >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ values >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return values ^ values >> np.uint64(31)


class Coder:
    def __init__(self, pieces: Pieces, dropout: float = 0.0, seed: int = 0):
        self.pieces, self.seed = pieces, seed
        self.limit = min(_M, int(dropout * 2**64))
        self.known = _Known()

    def keys(self, doc_key: int, start: int, n: int) -> np.ndarray:
        """Keys of the chunks ``start`` to ``start + n`` of a document."""
        base = xxhash.xxh64_intdigest((doc_key & _M).to_bytes(8, "little"), self.seed & _M)
        return _mixed(np.uint64(base) + np.arange(start + 1, start + n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def _segmented(self, chunks: list[str], keys: np.ndarray) -> list[bytes]:
        """Packed ids of occurrences of chunks."""
        if len(self.known.slots) > REMEMBERED:
            self.known = _Known()
        known = self.known
        numbers = list(map(known.slots.get, chunks))
        if None in numbers:
            known.learn(self.pieces, sorted({c for c, s in zip(chunks, numbers) if s is None}))
            numbers = list(map(known.slots.__getitem__, chunks))
        out = list(map(known.packed.__getitem__, numbers))
        if not self.limit:
            return out
        slots = np.array(numbers, np.int64)
        begins = known.starts[slots]
        many = known.starts[slots + 1] - begins
        ends = np.cumsum(many)
        merge = np.repeat(begins - ends + many, many)
        merge += np.arange(len(merge))
        skipped = np.flatnonzero(_skipped(np.repeat(keys, many), known.candidates[merge], self.limit))
        # The occurrence that each skipped merge belongs to.
        hit = np.zeros(len(chunks), bool)
        hit[np.searchsorted(ends, skipped, "right")] = True
        other = np.flatnonzero(hit)
        if len(other):
            own, _ = merged(self.pieces, [chunks[k] for k in other.tolist()], keys[other], self.limit)
            for k, ids in zip(other.tolist(), own):
                out[k] = ids
        return out

    def encode_many(self, texts: list[str | None], doc_keys: list[int]) -> list[bytes | None]:
        """Ids of texts as packed 32-bit numbers; a slice of bounded size is looked at at a time."""
        out: list[list[bytes] | None] = [None if t is None else [] for t in texts]
        held: list[tuple[int, int]] = []
        chunks: list[str] = []
        keys: list[np.ndarray] = []

        def flush() -> None:
            if chunks:
                found, at = self._segmented(chunks, np.concatenate(keys)), 0
                for k, n in held:
                    out[k].append(b"".join(found[at : at + n]))
                    at += n
            for x in (held, chunks, keys):
                x.clear()

        for k, (text, doc_key) in enumerate(zip(texts, doc_keys)):
            count = 0
            for part in sliced(" " + text) if text else ():
                found = self.pieces.chunks(part)
                held.append((k, len(found)))
                chunks += found
                keys.append(self.keys(doc_key, count, len(found)))
                count += len(found)
                if len(chunks) >= CHUNKS_AT_ONCE:
                    flush()
        flush()
        return [None if parts is None else b"".join(parts) for parts in out]

    def encode(self, text: str, doc_key: int = 0) -> bytes:
        return self.encode_many([text], [doc_key])[0]

    def decode(self, packed: bytes) -> str:
        """The text of packed ids, the blank put before it taken off."""
        meaning = self.pieces.meaning
        return b"".join([meaning[i] for i in np.frombuffer(packed, "<i4").tolist()]).decode()[1:]


def sliced(text: str, size: int = 1_000_000) -> Iterator[str]:
    """Slices of about ``size`` characters, cut before a blank that follows something else."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


_CODERS: dict[tuple, Coder] = {}


def _coder(shared, dropout: float, seed: int) -> Coder:
    """One coder per worker and setting, so that chunks stay known from task to task."""
    pieces = shared.value
    key = (id(pieces), dropout, seed)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(pieces, dropout, seed)
    return _CODERS[key]


def encoded(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", dropout: float = 0.1, seed: int = 17,
    model: str = DEFAULT_MODEL, digest: bool = False,
) -> DataFrame:
    """doc_id, pieces (ids), n_pieces and lossless (the pieces decode to the very text) for every row.

    With ``digest`` the pieces and the decoded text are replaced by their SHA-256 in the task:
    ids_sha256 (ids as little-endian 32-bit numbers) and decoded_sha256 (UTF-8).
    """
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(model))
    rows = docs.select(column(doc_id).cast("long").alias("doc_id"), F.xxhash64(column(doc_id).cast("string")).alias("key"), column(text).alias("text"))
    sha = lambda data: hashlib.sha256(data).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, dropout, seed)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_OUT):
                batch = whole.slice(at, ROWS_OUT)
                texts, keys = batch.column("text").to_pylist(), batch.column("key").to_pylist()
                packed = coder.encode_many(texts, [k & _M for k in keys])
                back = [None if p is None else coder.decode(p) for p in packed]
                sizes = np.array([len(p or b"") // 4 for p in packed], np.int64)
                same = pa.array([a == b for a, b in zip(texts, back)])
                head = [batch.column("doc_id"), pa.array(sizes), same]
                if digest:
                    own = [pa.array([None if p is None else sha(p) for p in packed], pa.string()),
                           pa.array([None if b is None else sha(b.encode()) for b in back], pa.string())]
                    yield pa.RecordBatch.from_arrays(head + own, ["doc_id", "n_pieces", "lossless", "ids_sha256", "decoded_sha256"])
                else:
                    ends = np.r_[0, np.cumsum(sizes)].astype(np.int32)
                    ids = pa.array(np.frombuffer(b"".join(p or b"" for p in packed), "<i4"))
                    lists = pa.ListArray.from_arrays(pa.array(ends), ids, mask=pa.array([p is None for p in packed]))
                    yield pa.RecordBatch.from_arrays([*head, lists], ["doc_id", "n_pieces", "lossless", "pieces"])

    tail = "ids_sha256 string, decoded_sha256 string" if digest else "pieces array<int>"
    return in_small_batches(rows).mapInArrow(run, f"doc_id long, n_pieces long, lossless boolean, {tail}")


def decoded(rows: DataFrame, pieces: str = "pieces", model: str = DEFAULT_MODEL) -> DataFrame:
    """The rows with a column ``text`` decoded from their pieces, whatever dropout made them."""
    shared = rows.sparkSession.sparkContext.broadcast(Pieces(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, 0.0, 0)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            texts = [None if i is None else coder.decode(np.array(i, "<i4").tobytes()) for i in ids]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    packed = rows.select(whole_row(rows).alias("row"), column(pieces).alias("ids"))
    schema = packed.drop("ids").withColumn("text", F.lit(None).cast("string")).schema
    out = in_small_batches(packed).mapInArrow(run, schema)
    names = [n for n in rows.columns if n != "text"]
    return out.select(*[F.col("row").getField(n).alias(n) for n in names], "text")
