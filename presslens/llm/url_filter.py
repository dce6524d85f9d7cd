"""URL filter by a weighted vocabulary and host rules.

An Aho-Corasick automaton of all terms reads a lower-cased url once and reports every term that
stands between boundaries, that is, next to no letter or digit.  Strict terms weigh as much as the
limit, soft ones 1; each term counts once a url, and a url whose weight reaches the limit is
blocked.  Host rules come first: the longest rule that fits decides alone.

The vocabulary and the rules are parameters of bounded size and travel with the task; urls are
never shuffled, so hot hosts do not matter.

Defined cases: a null url, or one without ``://``, has an empty host and path and fits no rule; a null
url is allowed; terms that are equal after lower-casing count once, strict before soft; rows that
repeat are judged alike; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import column

#: One of these is enough.
STRICT = (
    "casino", "escort", "hentai", "malware", "phishing", "porn", "porno", "roulette", "spam", "viagra", "warez", "xxx",
)
#: Several different ones are needed.
SOFT = (
    "adult", "ads", "bet", "bonus", "cheap", "click", "coupon", "crack", "deal", "free", "jackpot", "keygen", "loan",
    "lottery", "nude", "pills", "poker", "popup", "promo", "sexy", "slots", "track", "tracker", "win", "winner",
)
SOFT_LIMIT = 2
#: (host, path prefix, verdict); a rule also holds for all subdomains of its host.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path, both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null when none does."""
    name = verdict = F.lit(None).cast("string")
    for domain, prefix, says in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        name, verdict = F.when(fits, domain + prefix).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


class Vocabulary:
    def __init__(self, strict: Sequence[str], soft: Sequence[str], limit: int):
        import ahocorasick

        self.limit = limit
        self.weights = {t.lower(): 1 for t in soft if t} | {t.lower(): limit for t in strict if t}
        self.automaton = ahocorasick.Automaton()
        for term in self.weights:
            self.automaton.add_word(term, term)
        if self.weights:
            self.automaton.make_automaton()

    def hits(self, url: str | None) -> set[str]:
        """Different terms that stand between boundaries."""
        if not url or not self.weights:
            return set()
        low = url.translate(_ASCII_LOW)
        found = set()
        for end, term in self.automaton.iter(low):
            start = end + 1 - len(term)
            if not (start and low[start - 1] in _INNER) and not (end + 1 < len(low) and low[end + 1] in _INNER):
                found.add(term)
        return found

    def weight(self, terms: set[str]) -> int:
        return sum(self.weights[t] for t in terms)


_ASCII_LOW = {ord(a): b for a, b in zip(_UPPER, _LOWER)}
_INNER = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def judge(
    pages: DataFrame, url: str = "url", page_id: str = "page_id", strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT,
    soft_limit: int = SOFT_LIMIT, rules: Sequence[tuple[str, str, str]] = RULES,
) -> DataFrame:
    """page_id, host, path, rule, verdict, n_strict, n_soft, terms (sorted) for every row."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(column(page_id).alias("page_id"), column(url).alias("url"))
    hard = {t.lower() for t in strict}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(strict, soft, soft_limit)
        for batch in batches:
            found = [vocabulary.hits(u) for u in batch.column("url").to_pylist()]
            n_strict = [sum(t in hard for t in f) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"), pa.array(n_strict, pa.int64()),
                    pa.array([len(f) - n for f, n in zip(found, n_strict)], pa.int64()),
                    pa.array([",".join(sorted(f)) for f in found], pa.string()),
                    pa.array([vocabulary.weight(f) >= soft_limit and bool(f) for f in found], pa.bool_()),
                ],
                ["page_id", "url", "n_strict", "n_soft", "terms", "bad"],
            )

    kind = rows.schema["page_id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"page_id {kind}, url string, n_strict long, n_soft long, terms string, bad boolean")
    placed = counted.select("*", host.alias("host"), path.alias("path"))
    name, says = best_rule(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(says, F.when(F.col("bad"), "block").otherwise("allow"))
    return placed.select("page_id", "host", "path", name.alias("rule"), verdict.alias("verdict"), "n_strict", "n_soft", "terms")


def oracle(strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT, soft_limit: int = SOFT_LIMIT, rules: Sequence[tuple[str, str, str]] = RULES) -> str:
    """The same judgement in SQL: one regular expression a term."""

    def counted(terms: Sequence[str]) -> str:
        return " + ".join(f"regexp_matches(low, '(^|[^a-z0-9]){re.escape(t)}($|[^a-z0-9])')::BIGINT" for t in terms)

    listed = ", ".join(f"CASE WHEN regexp_matches(low, '(^|[^a-z0-9]){t}($|[^a-z0-9])') THEN '{t}' END" for t in sorted({*strict, *soft}))
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = [(f"(host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}')", h + p, v) for h, p, v in ordered]
    rule = " ".join(f"WHEN {f} THEN '{name}'" for f, name, _ in fits)
    says = " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits)
    return f"""
WITH cut AS (SELECT page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS low,
                    CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
     parts AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
                      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
     hits AS (SELECT *, {counted(strict)} AS n_strict, {counted(soft)} AS n_soft,
                     concat_ws(',', {listed}) AS terms FROM parts)
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {says} WHEN n_strict > 0 OR n_soft >= {soft_limit} THEN 'block' ELSE 'allow' END AS verdict,
       n_strict, n_soft, terms
FROM hits"""
