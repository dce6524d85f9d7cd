"""Secret scan with corpus-wide ownership, by DataFrame functions only.

Base kinds are found by their patterns.  Other long mixed tokens are candidates: whether one looks
live depends on who has it.  Hashes of all values are counted by distinct repositories and owners
over the whole corpus, and so are the different texts that hold it.  A value that several owners have,
or one owner in several repositories or in many texts, is an example that was copied around; one that
stays in its place and looks random is a live credential.  Live tokens are added to the spans as kind
``owned``; the classes of the base values are reported beside them.

Only hashes leave the row, never a value.  Owners and repositories are made distinct in steps that
are combined before each shuffle, and the most frequent values are joined by a bounded broadcast.

Defined cases: a null text is empty; a null owner or repository is one of its own; rows that repeat are
treated alike and count once in the ownership of a value; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import column, join_hot, keep

#: Fixed patterns; look-behinds only save attempts inside a run that was too short.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
TOKEN = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}"
KINDS = ("assign", "access", "hex", "owned")
SHORTEST_VALUE = 12
#: A value in the hands of at most so many owners can be live.
MOST_OWNERS = 1
#: In more repositories than these a value is a copied example, whoever owns them.
MOST_REPOSITORIES = 2
#: In more different texts than these it is one too, even in a single repository.
MOST_TEXTS = 50
#: Different characters a live value has at least.
LEAST_CHARACTERS = 10

_SPAN = "array<struct<start:bigint,kind:int,end:bigint,hash:string,live:boolean>>"
_NONE = f"cast(array() as {_SPAN})"


def _random_looking(value: Column) -> Column:
    several = F.size(F.array_distinct(F.split(value, ""))) >= LEAST_CHARACTERS
    return several & value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Matches of a pattern with their places: lengths of what lies between and of the matches add up."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    steps = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("hit"), values.alias("value"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr(_NONE).alias("out"))

    def add(state: Column, step: Column) -> Column:
        begin = state["at"] + F.length(step["gap"])
        end = begin + F.length(step["hit"])
        span = F.struct(
            begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), F.sha2(step["value"], 256).alias("hash"),
            _random_looking(step["value"]).alias("live"),
        )
        kept = F.when(F.length(step["value"]) >= least, F.concat(state["out"], F.array(span))).otherwise(state["out"])
        return F.struct(end.alias("at"), kept.alias("out"))

    every = F.aggregate(steps, start, add, lambda state: state["out"])
    return F.when(text.rlike(pattern), every).otherwise(F.expr(_NONE))


def _found(docs: DataFrame, text: str, doc_id: str, owner: Column, repository: Column) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        column(doc_id).alias("doc_id"), F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"), column(text).alias("text"),
    )
    base = F.concat(spans(body, ASSIGN, 0, 1, SHORTEST_VALUE), spans(body, ACCESS, 1), spans(body, HEX, 2))
    found = rows.select("doc_id", "owner", "repository", F.xxhash64("text").alias("text_key"), base.alias("base"), spans(body, TOKEN, 3).alias("token"))
    outside = lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    return found.withColumn("token", F.filter("token", lambda t: t["live"] & outside(t)))


def ownership(candidates: DataFrame) -> DataFrame:
    """hash, n_owners, n_repositories, n_texts, n_rows over (hash, owner, repository, text_key) rows, one per occurrence.

    Counts are made distinct from the finest key up, so a value that is everywhere is combined before every shuffle.
    """
    by_text = candidates.groupBy("hash", "owner", "repository", "text_key").agg(F.count("*").alias("n"))
    by_place = by_text.groupBy("hash", "owner", "repository").agg(F.count("*").alias("texts"), F.sum("n").alias("n"))
    by_owner = by_place.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("texts").alias("texts"), F.sum("n").alias("n"))
    return by_owner.groupBy("hash").agg(
        F.count("*").alias("n_owners"), F.sum("repositories").alias("n_repositories"), F.sum("texts").alias("n_texts"), F.sum("n").alias("n_rows")
    )


def scan(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", owner: Column | None = None, repository: Column | None = None,
    most_owners: int = MOST_OWNERS, most_repositories: int = MOST_REPOSITORIES, most_texts: int = MOST_TEXTS,
) -> DataFrame:
    """doc_id, base and all spans (start, kind number, end), n_live and n_example of the base values.

    ``owner`` is the column ``source`` and ``repository`` an owner's documents of one language unless
    others are given.
    """
    owner = column("source") if owner is None else owner
    repository = F.concat_ws("/", owner, column("lang")) if repository is None else repository
    found = keep(_found(docs, text, doc_id, owner, repository), "secret-candidates")
    every = found.select("doc_id", "text_key", "owner", "repository", F.explode(F.concat("base", "token")).alias("span"))
    every = every.select("doc_id", "text_key", "owner", "repository", "span", F.col("span.hash").alias("hash"))
    owned = keep(ownership(every), "secret-owners")
    looked = join_hot(every, owned, ["hash"], "n_rows")
    copied = (F.col("n_owners") > most_owners) | (F.col("n_repositories") > most_repositories) | (F.col("n_texts") > most_texts)
    live = F.col("span.live") & ~copied
    base = F.col("span.kind") < 3
    judged = looked.groupBy("doc_id", "text_key", "owner", "repository").agg(
        F.collect_set(F.when(~base & live, F.struct("span.start", "span.kind", "span.end"))).alias("added"),
        F.collect_set(F.when(base & live, F.struct("span.start", "span.kind"))).alias("live"),
        F.collect_set(F.when(base & copied, F.struct("span.start", "span.kind"))).alias("examples"),
    )
    # One row for each set of equal rows above, so this join cannot multiply.
    keys = ["doc_id", "text_key", "owner", "repository"]
    renamed = judged.select(*[F.col(k).alias(f"of_{k}") for k in keys], "added", "live", "examples")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"of_{k}"))
    bare = F.array_sort(F.transform("base", lambda b: F.struct(b["start"], b["kind"], b["end"])))
    placed = found.select(*keys, bare.alias("base")).join(renamed, same, "left")
    count = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    return placed.select(
        "doc_id", "base", F.array_sort(F.concat("base", F.coalesce("added", F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint>>)")))).alias("spans"),
        F.when(F.col("live").isNull(), 0).otherwise(count("live")).cast("long").alias("n_live"),
        F.when(F.col("examples").isNull(), 0).otherwise(count("examples")).cast("long").alias("n_example"),
    )


def listed(found: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query, derived from the spans of ``scan``."""
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), "n_live", "n_example",
    )


#: The patterns as RE2 knows them, with the group of the value and its least length.
_RE2 = (
    # fixed values
    (r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 1, SHORTEST_VALUE),
    (r"AKIA[A-Z0-9]{14,}", 0, 0),
    (r"[0-9a-f]{16,}", 0, 0),
    (r"[A-Za-z0-9_-]{20,}", 0, 0),
)
_FOUND = " UNION ALL\n".join(
    f"""        SELECT r, {k} AS kind, {least} AS least, string_split_regex(text, '{p}') AS gaps,
               regexp_extract_all(text, '{p}', 0) AS hits, regexp_extract_all(text, '{p}', {group}) AS vals FROM docs"""
    for k, (p, group, least) in enumerate(_RE2)
)
#: The same scan in SQL.
ORACLE = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS owner,
                     concat_ws('/', source, lang) AS repository, coalesce(text, '') AS text FROM documents),
     found AS (
{found}),
     each AS (SELECT r, kind, least, unnest(range(1, len(hits) + 1)) AS i, gaps, hits, vals FROM found),
     raw AS (
         SELECT r, kind, coalesce(list_sum([length(x) for x in gaps[1:i]]), 0)::BIGINT + coalesce(list_sum([length(x) for x in hits[1:i-1]]), 0)::BIGINT AS start,
                length(hits[i]) AS size, vals[i] AS value FROM each WHERE length(vals[i]) >= least),
     judged AS (
         SELECT r, kind, start, start + size AS stop, sha256(value) AS hash,
                len(list_distinct(string_split(value, ''))) >= 10 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AS live FROM raw),
     every AS (
         SELECT * FROM judged t WHERE kind < 3 OR (live AND NOT EXISTS (
             SELECT 1 FROM judged b WHERE b.r = t.r AND b.kind < 3 AND b.start < t.stop AND t.start < b.stop))),
     owners AS (SELECT hash, count(DISTINCT owner) > 1 OR count(DISTINCT (owner, repository)) > 2 OR count(DISTINCT (owner, repository, text)) > 50 AS copied
                FROM every JOIN docs USING (r) GROUP BY hash),
     known AS (SELECT *, ['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || start || ':' || stop AS span FROM every JOIN owners USING (hash)),
     out AS (
         SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
                string_agg(span, ',' ORDER BY start, kind, stop) FILTER (kind < 3) AS base,
                string_agg(span, ',' ORDER BY start, kind, stop) FILTER (kind < 3 OR NOT copied) AS spans,
                count(*) FILTER (kind < 3 AND live AND NOT copied) AS n_live, count(*) FILTER (kind < 3 AND copied) AS n_example
         FROM known GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM docs LEFT JOIN out USING (r)
""".replace("{found}", _FOUND)
