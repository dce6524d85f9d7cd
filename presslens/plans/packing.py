"""Stored form of profiles: metadata columns plus one JSON text per feature set."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.functions.text import name, text
from presslens.operators.latest import ranked
from presslens.operators.numbering import chunk_summary, chunked
from presslens.spec import FeatureSpec


def pack_features(
    df: DataFrame,
    spec: FeatureSpec,
    window_days: int,
    pipeline_version: str,
    created_at: Column | None = None,
) -> DataFrame:
    """Wide profile to its stored row.

    Values become texts; nulls and expected columns that are absent get the default of their set.
    """
    present = set(df.columns)

    # SQL text: hundreds of column objects take longer to make than the rows to pack.
    def cell(column: str, default: str) -> str:
        if column not in present:
            return f"{text(column)}, {text(default)}"
        return f"{text(column)}, coalesce(CAST({name(column)} AS STRING), {text(default)})"

    packed = [
        F.expr(f"to_json(named_struct({', '.join(cell(n, default) for n in names)}))").alias(f"features__{set_name}")
        for set_name, (default, names) in spec.feature_sets().items()
        if names
    ]
    return df.select(
        "date", spec.id_column, "outcome", "outcome_date",
        F.lit(pipeline_version).alias("pipeline_version"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
        F.lit(int(window_days)).alias("window_days"),
        F.lit(",".join(spec.aliases)).alias("feature_aggregation_functions"),
        *packed,
    )


def unpack_features(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Stored row back to one column per feature, numbers as doubles, texts as they are.

    Each JSON text is parsed once into a struct of the expected fields; fields that an older row
    lacks are filled with the default of the set.
    """
    sets = spec.feature_sets()
    stored = {f"features__{n}": (default, names) for n, (default, names) in sets.items() if names}
    kept = [c for c in df.columns if c not in stored]
    found = [c for c in stored if c in df.columns]
    fields = {c: ", ".join(f"{name(n)} STRING" for n in stored[c][1]) for c in found}
    parsed = df.selectExpr(*map(name, kept), *[f"from_json({name(c)}, {text(fields[c])}) AS {name(c)}" for c in found])

    def field(column: str, feature: str, default: str) -> str:
        value = f"{name(column)}.{name(feature)}" if column in found else "CAST(NULL AS STRING)"
        cell = f"coalesce(try_cast({value} AS DOUBLE), 0.0D)" if default == "0.0" else f"coalesce({value}, {text(default)})"
        return f"{cell} AS {name(feature)}"

    columns = [field(column, n, default) for column, (default, names) in stored.items() for n in names]
    return parsed.selectExpr(*map(name, kept), *columns)


def retrieve_profiles(
    profiles: DataFrame,
    id_col: str,
    window_days: int,
    start: dt.date | str,
    end: dt.date | str,
    history_labels: Sequence[str] = (),
    deduplicate: bool | None = None,
) -> DataFrame:
    """Profiles of one window length with outcomes in a period.

    ``history_labels`` adds all older rows with these outcomes (training).  Without them only the
    latest profile of each id is kept (prediction) unless ``deduplicate`` says otherwise.
    """
    first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    recent = F.col("outcome_date") >= first
    if history_labels:
        recent = recent | F.col("outcome").isin(*history_labels)
    rows = profiles.where(
        (F.col("window_days") == window_days) & (F.col("outcome_date") <= last) & recent
    )
    if deduplicate is None:
        deduplicate = not history_labels
    return latest_profile(rows, id_col) if deduplicate else rows


def latest_profile(profiles: DataFrame, id_col: str) -> DataFrame:
    """Rows of the latest day of each id, ties kept."""
    return ranked(profiles, [id_col], [F.col("date").desc()])


def profile_first_user(
    profiles: DataFrame, browser_users: DataFrame, start: dt.date | str, end: dt.date | str
) -> DataFrame:
    """Profiles with the first user id of their browser in a period, as a list of one.

    All that the payment history needs; the minimum is combined before the shuffle, so a browser
    shared by everybody is no larger than others.
    """
    first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    pairs = browser_users.where(F.col("date").between(first, last))
    users = pairs.groupBy("browser_id").agg(F.array(F.min("user_id")).alias("user_ids"))
    return profiles.join(users, "browser_id", "left")


def profile_user_ids(
    profiles: DataFrame, browser_users: DataFrame, start: dt.date | str, end: dt.date | str
) -> DataFrame:
    """Profiles with the sorted distinct users of their browser in a period."""
    first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    pairs = browser_users.where(F.col("date").between(first, last))
    users = pairs.groupBy("browser_id").agg(F.array_sort(F.collect_set("user_id")).alias("user_ids"))
    return profiles.join(users, "browser_id", "left")


def profile_user_chunks(
    profiles: DataFrame, browser_users: DataFrame, start: dt.date | str, end: dt.date | str, size: int = 1000
) -> DataFrame:
    """Profiles with ``n`` users of their browser in a period, ``n_chunks`` and ``head``, the first ``size`` of them.

    The other users stay in the chunk table (``numbering.chunked``), so no cell grows with a busy browser.
    """
    first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    chunks = chunked(browser_users.where(F.col("date").between(first, last)), "browser_id", "user_id", size)
    zero = F.lit(0).cast("long")
    joined = profiles.join(chunk_summary(chunks, "browser_id"), "browser_id", "left")
    return joined.withColumns({c: F.coalesce(c, zero) for c in ("n", "n_chunks")})
