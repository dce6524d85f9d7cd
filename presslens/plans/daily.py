"""Raw pageviews to day tables.

The day tables are views of one intermediate: *facet counts*.  Every pageview is turned into a few
``(facet, key)`` pairs (hour, session, medium, category, tags, counterpart id) and counted per
(date, id, facet, key).  The first shuffle is on that fine key, after map-side counting, so a busy
reader is spread over its sessions, tags and hours; the second one moves counts only.  Distinct
counts need no row expansion per distinct column and the long tag / category / medium tables are
plain filters of the same counts.

Input columns: user_id ('' = anonymous), browser_id, subscriber, derived_referer_medium, category,
tags (optional), time, session_id, user_agent, event_id (file order, breaks ties in time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.functions.agents import FIELDS, AgentRules, agent_fields
from presslens.functions.calendar import hour_label
from presslens.functions.flags import is_true
from presslens.functions.labels import COMMERCE_STEPS
from presslens.operators.latest import latest_by
from presslens.spec import HOUR_COLUMNS, HOUR_RANGES, HOURS, RANGE_COLUMNS

LONG_TABLES = ("tags", "categories", "referer_mediums")
COMMERCE_COLUMNS = ("commerce_checkouts", "commerce_payments", "commerce_purchases", "commerce_refunds")
_COUNTERPART = {"user_id": "browser_id", "browser_id": "user_id"}


def with_date(df: DataFrame) -> DataFrame:
    """Add the UTC day of ``time`` unless the frame carries a file date already."""
    return df if "date" in df.columns else df.withColumn("date", F.to_date("time"))


def subscriber_views(pageviews: DataFrame) -> DataFrame:
    """Pageviews that count for users: known user, subscriber, non-empty medium."""
    return with_date(pageviews).where(
        (F.col("user_id") != "")
        & is_true(F.col("subscriber"))
        & (F.col("derived_referer_medium") != "")
    )


def visitor_views(pageviews: DataFrame) -> DataFrame:
    """Pageviews that count for browsers: not a subscriber, non-empty medium."""
    return with_date(pageviews).where(
        ~is_true(F.col("subscriber")) & (F.col("derived_referer_medium") != "")
    )


def views_for(pageviews: DataFrame, id_col: str) -> DataFrame:
    return subscriber_views(pageviews) if id_col == "user_id" else visitor_views(pageviews)


def tag_keys(views: DataFrame) -> Column:
    """Array of the tags of a pageview, repeats kept; without a tags column the single key ''."""
    if "tags" not in views.columns:
        return F.array(F.lit(""))
    return F.filter(F.split(F.coalesce("tags", F.lit("")), ","), lambda t: t != "")


def _facet_pairs(pageviews: DataFrame, id_col: str, facets: tuple[str, ...] | None = None) -> DataFrame:
    """One row per pageview that counts for the id and pair of facet and key."""
    views = views_for(pageviews, id_col)
    other = _COUNTERPART[id_col]
    keys = {
        "hours": F.array(F.hour("time").cast("string")),
        "sessions": F.array("session_id"),
        "ids": F.array(other),
        "referer_mediums": F.array("derived_referer_medium"),
        "categories": F.array("category"),
        "tags": tag_keys(views),
    }

    def pairs_of(facet: str) -> Column:
        return F.transform(keys[facet], lambda k: F.struct(F.lit(facet).alias("facet"), k.alias("key")))

    pairs = F.concat(*[pairs_of(f) for f in facets or tuple(keys)])
    return views.select(
        "date",
        id_col,
        (F.col("derived_referer_medium") == "direct").alias("direct"),
        F.explode(pairs).alias("pair"),
    ).select("date", id_col, "pair.facet", "pair.key", "direct")


def facet_counts(pageviews: DataFrame, id_col: str, facets: tuple[str, ...] | None = None) -> DataFrame:
    """``(date, id, facet, key, pageviews, is_direct)`` over the pageviews that count for the id."""
    return (
        _facet_pairs(pageviews, id_col, facets)
        .groupBy("date", id_col, "facet", "key")
        .agg(F.count("*").alias("pageviews"), F.max("direct").alias("is_direct"))
    )


#: Facets that profiles read; ``timespent`` and ``commerce`` come from logs of their own.
PROFILE_FACETS = ("hours", "sessions", "referer_mediums", "categories")


def log_counts(
    pageviews: DataFrame, id_col: str, timespent: DataFrame | None = None, commerce: DataFrame | None = None,
) -> DataFrame:
    """All that a profile needs from the logs: ``(date, id, facet, key, pageviews, is_direct)``.

    Each log is scanned once and the counts of all of them meet in one shuffle, on the fine key.
    Facet ``timespent`` holds seconds, facet ``commerce`` steps.
    """
    rows = _facet_pairs(pageviews, id_col, PROFILE_FACETS).withColumn("n", F.lit(1).cast("long"))
    more = {}
    if timespent is not None:
        known = timespent.where(F.col(id_col) != "") if id_col == "user_id" else timespent
        more["timespent"] = known, F.lit(""), F.col("timespent").cast("long")
    if commerce is not None:
        more["commerce"] = _known_steps(commerce), F.col("step"), F.lit(1).cast("long")
    for facet, (log, key, n) in more.items():
        rows = rows.unionByName(
            log.select("date", id_col, F.lit(facet).alias("facet"), key.alias("key"), F.lit(False).alias("direct"), n.alias("n"))
        )
    return rows.groupBy("date", id_col, "facet", "key").agg(
        F.sum("n").alias("pageviews"), F.max("direct").alias("is_direct")
    )


def key_counts(pageviews: DataFrame, id_col: str, key: str) -> DataFrame:
    """Long day table ``(date, id, <key>, pageviews)`` for tags, categories or referer_mediums."""
    if key not in LONG_TABLES:
        raise ValueError(f"key must be one of {LONG_TABLES}, got {key!r}")
    counts = facet_counts(pageviews, id_col, (key,))
    return counts.select("date", id_col, F.col("key").alias(key), "pageviews")


def hour_buckets(pageviews: DataFrame, id_col: str) -> DataFrame:
    """24 hourly and six four-hour pageview counts per (date, id)."""
    hours = facet_counts(pageviews, id_col, ("hours",))
    return hours.groupBy("date", id_col).agg(*_hour_columns())


def _hour_columns() -> list[Column]:
    """Pageviews per hour and per four-hour range out of facet counts."""

    def between(first: int, last: int, name: str) -> Column:
        keys = ", ".join(f"'{h}'" for h in range(first, last))
        hit = f"CASE WHEN facet = 'hours' AND key IN ({keys}) THEN pageviews ELSE 0 END"
        return F.expr(f"sum({hit}) AS {name}")

    singles = [between(h, h + 1, name) for h, name in zip(HOURS, HOUR_COLUMNS, strict=True)]
    ranges = [between(a, b, name) for (a, b), name in zip(HOUR_RANGES, RANGE_COLUMNS, strict=True)]
    return singles + ranges


def counter_map(facet: Column, name: str) -> Column:
    """Counts of one facet as a map, to be used inside a ``(date, id)`` aggregate."""
    key = hour_label(F.col("key")) if name == "hours" else F.col("key")
    entries = F.collect_list(F.when(facet == name, F.struct(key.alias("k"), F.col("pageviews"))))
    return F.map_from_entries(F.array_sort(entries))


def day_table(facets: DataFrame, id_col: str) -> DataFrame:
    """Facet counts to one row per (date, id).  Counter maps hold only keys that occur."""
    facet = F.col("facet")
    others = f"{_COUNTERPART[id_col]}s"
    is_session = facet == "sessions"
    return facets.groupBy("date", id_col).agg(
        F.array_sort(F.collect_list(F.when((facet == "ids") & (F.col("key") != ""), F.col("key")))).alias(others),
        F.coalesce(F.sum(F.when(facet == "hours", F.col("pageviews"))), F.lit(0)).alias("pageviews"),
        F.count_if(is_session).alias("sessions"),
        F.count_if(is_session & F.col("is_direct")).alias("sessions_without_ref"),
        counter_map(facet, "referer_mediums").alias("referer_mediums_pageviews"),
        counter_map(facet, "categories").alias("article_categories_pageviews"),
        counter_map(facet, "tags").alias("article_tags_pageviews"),
        counter_map(facet, "hours").alias("hour_interval_pageviews"),
        *_hour_columns(),
    )


COUNTER_MAPS = (
    "referer_mediums_pageviews", "article_categories_pageviews",
    "article_tags_pageviews", "hour_interval_pageviews",
)


def counters_to_json(day: DataFrame) -> DataFrame:
    """The four counter maps as JSON texts, the stored form."""
    return day.withColumns({c: F.to_json(c) for c in COUNTER_MAPS})


def timespent_sums(timespent: DataFrame, id_col: str) -> DataFrame:
    """Seconds per (date, id) from the time-spent log; rows without an id are dropped."""
    return (
        timespent.where(F.col(id_col) != "")
        .groupBy("date", id_col)
        .agg(F.sum(F.col("timespent").cast("long")).alias("timespent"))
    )


def with_timespent(day: DataFrame, timespent: DataFrame | None, id_col: str) -> DataFrame:
    """Add ``timespent``; 0 without a log.  Log rows of ids without a day row do not count."""
    if timespent is None:
        return day.withColumn("timespent", F.lit(0).cast("long"))
    sums = timespent_sums(timespent, id_col) if id_col == "user_id" else (
        timespent.groupBy("date", id_col).agg(F.sum(F.col("timespent").cast("long")).alias("timespent"))
    )
    return day.join(sums, ["date", id_col], "left").fillna(0, ["timespent"])


def user_days(pageviews: DataFrame, timespent: DataFrame | None = None) -> DataFrame:
    """``aggregated_user_days``: one row per day and subscriber."""
    return with_timespent(day_table(facet_counts(pageviews, "user_id"), "user_id"), timespent, "user_id")


def _known_steps(commerce: DataFrame) -> DataFrame:
    """Commerce rows of known browsers.  An unknown step is an error."""
    checked = F.when(F.col("step").isin(*COMMERCE_STEPS), F.col("step")).otherwise(
        F.raise_error(
            F.concat(F.lit("unknown commerce step: "), F.coalesce("step", F.lit("null")),
                     F.lit(" for browser_id: "), F.col("browser_id"))
        ).cast("string")
    )
    return with_date(commerce).where(F.col("browser_id") != "").withColumn("step", checked)


def commerce_steps(commerce: DataFrame) -> DataFrame:
    """Counts of the four commerce steps per (date, browser)."""
    return _known_steps(commerce).groupBy("date", "browser_id").agg(
        *[
            F.count_if(F.col("step") == step).alias(name)
            for step, name in zip(COMMERCE_STEPS, COMMERCE_COLUMNS, strict=True)
        ]
    )


def _last_agent(rows: DataFrame) -> DataFrame:
    return latest_by(rows, ["date", "browser_id"], F.struct("time", "event_id"), ["user_agent"])


def agent_columns(df: DataFrame, rules: AgentRules | None = None) -> DataFrame:
    """Replace ``user_agent`` by the ten browser, system and device fields."""
    fields = agent_fields(F.col("user_agent"), rules)
    kept = [c for c in df.columns if c != "user_agent"]
    return df.select(*kept, *[fields[name].alias(name) for name in FIELDS])


def browsers_dim(pageviews: DataFrame, rules: AgentRules | None = None) -> DataFrame:
    """``browsers``: device fields of the last user agent per day and browser, over all pageviews."""
    return agent_columns(_last_agent(with_date(pageviews)), rules)


def agents_of_users(pageviews: DataFrame, rules: AgentRules | None = None) -> DataFrame:
    """``browsers`` joined with ``browser_users``, from one scan and without the join.

    The last agent of each (day, browser, user) is an aggregate; the last of the browser is the
    last of those.
    """
    at = F.struct("time", "event_id")
    pairs = with_date(pageviews).groupBy("date", "browser_id", "user_id").agg(
        F.max(at).alias("__at"), F.max_by(F.struct("user_agent"), at).alias("__agent")
    )
    last = F.max_by("__agent", "__at").over(Window.partitionBy("date", "browser_id"))
    rows = pairs.withColumn("user_agent", last["user_agent"]).where(F.col("user_id") != "")
    return agent_columns(rows.drop("__at", "__agent"), rules)


def browser_users(pageviews: DataFrame) -> DataFrame:
    """``browser_users``: distinct (date, browser, user) pairs with a known user."""
    rows = with_date(pageviews).where(F.col("user_id") != "")
    return rows.select("date", "browser_id", "user_id").distinct()


def browser_days(
    pageviews: DataFrame,
    timespent: DataFrame | None = None,
    commerce: DataFrame | None = None,
    rules: AgentRules | None = None,
) -> DataFrame:
    """``aggregated_browser_days``: one row per day and browser of non-subscribers."""
    day = day_table(facet_counts(pageviews, "browser_id"), "browser_id")
    agents = agent_columns(_last_agent(visitor_views(pageviews)), rules)
    day = with_timespent(day.join(agents, ["date", "browser_id"], "left"), timespent, "browser_id")
    if commerce is None:
        return day.select("*", *[F.lit(0).cast("long").alias(c) for c in COMMERCE_COLUMNS])
    day = day.join(commerce_steps(commerce), ["date", "browser_id"], "left")
    return day.fillna(0, list(COMMERCE_COLUMNS))


def device_brands(browsers: DataFrame, end, days: int = 90) -> DataFrame:
    """Lower-cased device brands seen in the ``days`` days up to ``end``."""
    last = F.lit(str(end)).cast("date")
    recent = browsers.where(F.col("date").between(F.date_sub(last, days), last))
    return recent.select(F.lower("device_brand").alias("device_brand")).distinct()
