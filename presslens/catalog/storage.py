"""Reading, writing and the stored form of profiles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from presslens.catalog.daily import event_table, pageviews, user_day_table
from presslens.catalog.inputs import FIRST_DAY, LAST_DAY
from presslens.catalog.registry import TABLES, load, query
from presslens.catalog.crm import DIFF_COLUMNS, PAIR_COLUMNS, STAT_COLUMNS, user_history, user_rows
from presslens.catalog.rolling import SPECS, USER_WINDOW, browser_outcomes, browser_profile, rounded
from presslens.functions.ids import parse_pg_array
from presslens.functions.labels import CONVERSION_LABELS, labels_of
from presslens.plans import daily, outcomes, packing
from presslens.plans.store import ProfileStore
from presslens.session import scratch_dir
from presslens.sources import files, relational, sinks
from presslens.spec import HOUR_COLUMNS, RANGE_COLUMNS, WINDOW_SUFFIXES, change_column

DAYS = files.date_range(dt.date.fromisoformat(FIRST_DAY), dt.date.fromisoformat(LAST_DAY))


@query("parse_pg_array", "SELECT event_id, unnest(string_split(tags, ',')) AS tag FROM fx_pageviews")
def pg_arrays(spark, sf):
    literal = F.concat(F.lit("{"), F.col("tags"), F.lit("}"))
    rows = pageviews(spark, sf).select("event_id", parse_pg_array(literal).alias("tags"))
    return rows.select("event_id", F.explode("tags").alias("tag"))


_PARAM_SQL = """
    SELECT date, browser_id, count(*) AS n FROM {source}
    WHERE date BETWEEN {first} AND {last} GROUP BY date, browser_id"""


@query(
    "param_query",
    _PARAM_SQL.format(source="fx_pageviews", first=f"DATE '{FIRST_DAY}'", last=f"DATE '{LAST_DAY}'"),
)
def param_query(spark, sf):
    text = _PARAM_SQL.format(source="{source}", first=":start_time", last=":end_time")
    return relational.param_query(
        spark, text,
        {"start_time": dt.date.fromisoformat(FIRST_DAY), "end_time": dt.date.fromisoformat(LAST_DAY)},
        {"source": pageviews(spark, sf)}, require_rows=True,
    )


@query("incremental_sync", f"SELECT * FROM fx_subscriptions WHERE CAST(created_at AS DATE) <= DATE '{LAST_DAY}'")
def incremental_sync(spark, sf):
    """The stored target holds the first years; the sync appends everything newer up to the last day."""
    source, path = load(spark, sf, "fx_subscriptions"), scratch_dir(spark, "synced")
    sinks.sync_stored(source.where("id % 2 = 0"), path, "2021-06-30", ids=["id"])
    # Half of the rows were late; those of the mark's day arrive with the next run, once.
    late = source.where(F.to_date("created_at") < F.lit("2021-06-30").cast("date")).where("id % 2 = 1")
    sinks.append(late, path)
    return sinks.sync_stored(source, path, LAST_DAY, ids=["id"])


@query("prediction_tables", """SELECT browser_id, date, count(*) AS n_predictions, 1::BIGINT AS n_stored,
    arg_max(event_id, (created_at, event_id)) AS event_id, arg_max(predicted_outcome, (created_at, event_id)) AS predicted_outcome
    FROM fx_predictions GROUP BY 1, 2""")  # fmt: skip
def prediction_tables(spark, sf):
    """The log takes every prediction; the table with a unique index keeps the newest per browser and day, twice offered."""
    rows = load(spark, sf, "fx_predictions").select("browser_id", "date", "predicted_outcome", "model_version", "created_at", "event_id")
    log, table = scratch_dir(spark, "predictions_log"), scratch_dir(spark, "predictions")
    sinks.append(rows, log)
    keys = ["browser_id", "date"]
    newest = ["created_at", "event_id"]
    sinks.upsert(rows.where("event_id % 2 = 0"), table, keys, newest, ["date"])
    sinks.upsert(rows, table, keys, newest, ["date"])
    held = sinks.upsert(rows, table, keys, newest, ["date"]).groupBy(*keys).agg(
        F.count("*").alias("n_stored"), F.max("event_id").alias("event_id"), F.max("predicted_outcome").alias("predicted_outcome")
    )
    return spark.read.parquet(log).groupBy(*keys).agg(F.count("*").alias("n_predictions")).join(held, keys)


@query(
    "retention",
    f"SELECT * FROM fx_subscriptions WHERE CAST(created_at AS DATE) >= DATE '{LAST_DAY}' - 365",
)
def retention(spark, sf):
    """Month partitions are written, expired ones dropped, and what is left is read back."""
    dated = load(spark, sf, "fx_subscriptions").withColumn("date", F.trunc(F.to_date("created_at"), "month"))
    path = scratch_dir(spark, "by_month")
    sinks.write_partitions(dated, path, ["date"])
    # A folder holds up to 31 days, so it expires that much later; its early days are filtered.
    sinks.drop_expired(spark, path, LAST_DAY, 365 + 31)
    left = spark.read.parquet(path).select(*[c for c in dated.columns if c != "date"])
    return sinks.retained(left, LAST_DAY, column="created_at")


# ---- files -------------------------------------------------------------------------------------
@query(
    "read_day_csv",
    """SELECT date, user_id, browser_id, subscriber, derived_referer_medium, category, time,
    session_id, user_agent, tags FROM fx_pageviews""",
)
def read_day_csv(spark, sf):
    """Write the log as one delimited folder per day and read it back by day."""
    folder = scratch_dir(spark, "logs")
    rows = pageviews(spark, sf).drop("timespent", "event_id").withColumn(
        "stamp", F.date_format("date", "yyyyMMdd")
    )
    writer = rows.drop("date").hint("rebalance", "stamp").write.partitionBy("stamp")
    writer.option("header", True).option("sep", ";").option("compression", "gzip").option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"
    ).csv(f"{folder}/pageviews")
    log = files.read_day_csv(spark, folder, "pageviews", DAYS, missing="skip", layout="{kind}/stamp={stamp}")
    return log.drop("event_id")


@query(
    "jsonl_round_trip",
    "SELECT date, browser_id, user_ids FROM (SELECT date, browser_id, string_agg(user_id, ',' ORDER BY user_id) AS user_ids FROM dim_browser_users GROUP BY 1, 2)",
)
def jsonl_round_trip(spark, sf):
    path = scratch_dir(spark, "jsonl")
    pairs = daily.browser_users(pageviews(spark, sf))
    users = pairs.groupBy("date", "browser_id").agg(F.array_sort(F.collect_set("user_id")).alias("user_ids"))
    sinks.write_jsonl(users, path)
    back = files.read_jsonl(spark, path, "date date, browser_id string, user_ids array<string>")
    return back.withColumn("user_ids", F.array_join("user_ids", ","))


_STORED = ("date", "user_id", "pageviews", "timespent", "sessions", "sessions_without_ref",
           *HOUR_COLUMNS, *RANGE_COLUMNS)


@query("idempotent_write", f"SELECT {', '.join(_STORED)} FROM u_days")
def idempotent_write(spark, sf):
    """All days once, then the second half again: the table holds every row once."""
    path = scratch_dir(spark, "user_days")
    days = user_day_table(spark, sf).select(*_STORED)
    sinks.write_partitions(days, path, ["date"])
    again = days.where(F.col("date") >= F.lit("2024-01-16").cast("date"))
    sinks.write_partitions(again, path, ["date"])
    return spark.read.parquet(path).select(*_STORED)


# ---- profiles ----------------------------------------------------------------------------------
VERSION = "1.01"
WINDOW = 7
def _stored_sql(spec, present: set[str]) -> str:
    """Every stored column of a level as it comes back: numbers, or texts with the default of their set."""
    cells = {"0.0": "round(coalesce(CAST({c} AS DOUBLE), 0.0), 6)", "False": "coalesce(CAST({c} AS VARCHAR), 'False')", "": "coalesce(CAST({c} AS VARCHAR), '')"}
    absent = {"0.0": "0.0::DOUBLE", "False": "'False'", "": "''"}
    return ", ".join(
        f"{(cells[default].format(c=c) if c in present else absent[default])} AS {c}"
        for default, names in spec.feature_sets().values()
        for c in names
    )


def _profile_columns(spec) -> set[str]:
    """Columns that a computed profile of a level has."""
    stems = spec.windowed_stems()
    own = {"day_of_week", "is_active_on_date", "days_since_last_active", *spec.device_columns(), *spec.categorical_columns(), *spec.bool_columns()}
    return own | {f"{stem}{s}" for stem in stems for s in WINDOW_SUFFIXES} | set(map(change_column, stems))


def _feature_names(spec) -> list[str]:
    return [c for _, names in spec.feature_sets().values() for c in names]


TABLES["b_stored"] = f"""
    SELECT o.browser_id, o.date, o.outcome, o.outcome_date,
      {_stored_sql(SPECS["b"], _profile_columns(SPECS["b"]) | {"shared_account_logins_past_30_days"})}
    FROM b_outcome o LEFT JOIN login_counts c ON o.browser_id = c.browser_id AND o.date = c.date"""


def packed_profiles(spark, sf):
    # Written once: hundreds of columns packed in the plan that computes them are one huge expression.
    rows = sinks.stored(browser_outcomes(spark, sf), scratch_dir(spark, "wide"))
    created = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return packing.pack_features(rows, SPECS["b"], WINDOW, VERSION, created)


def _shown(unpacked, spec=SPECS["b"]):
    return rounded(unpacked.select(spec.id_column, "date", "outcome", "outcome_date", *_feature_names(spec)))


_PACKED = SPECS["b"].numeric_columns()


@query(
    "pack_features",
    f"""SELECT browser_id, date, outcome, outcome_date, '{VERSION}' AS pipeline_version, {WINDOW} AS window_days,
    'avg' AS feature_aggregation_functions, device, {', '.join(_PACKED)} FROM b_stored""",
)
def pack_features(spark, sf):
    packed = packed_profiles(spark, sf)
    numbers = [
        F.get_json_object("features__numeric_columns", f"$.{c}").cast("double").alias(c) for c in _PACKED
    ]
    return rounded(
        packed.select(
            "browser_id", "date", "outcome", "outcome_date", "pipeline_version", "window_days",
            "feature_aggregation_functions",
            F.get_json_object("features__categorical_columns", "$.device").alias("device"), *numbers,
        )
    )


@query("unpack_features", "SELECT * FROM b_stored")
def unpack_features(spark, sf):
    return _shown(packing.unpack_features(packed_profiles(spark, sf), SPECS["b"]))


@query("profile_write", "SELECT * FROM b_stored")
def profile_write(spark, sf):
    """Store packed profiles, store one day again, read back."""
    path = scratch_dir(spark, "profiles")
    packed = sinks.stored(packed_profiles(spark, sf), scratch_dir(spark, "packed"))
    sinks.write_profiles(packed, path)
    sinks.write_profiles(packed.where(F.col("date") == F.lit(LAST_DAY).cast("date")), path)
    return _shown(packing.unpack_features(spark.read.parquet(path), SPECS["b"]))


@query("profile_backfill", "SELECT * FROM b_profile")
def profile_backfill(spark, sf):
    """Every day in one pass, then the last day once more on its own: both ways agree."""
    path = scratch_dir(spark, "backfill")
    sinks.write_partitions(browser_profile(spark, sf), path, ["date"])
    sinks.write_partitions(browser_profile(spark, sf, LAST_DAY, LAST_DAY), path, ["date"])
    return rounded(spark.read.parquet(path))


TABLES["b_labelled"] = """
    SELECT f.browser_id, f.date, f.date + 1 AS outcome_date, 30 AS window_days,
      CASE WHEN e.type IN ('conversion', 'shared_account_login') THEN e.type ELSE 'no_conversion' END AS outcome
    FROM b_days f LEFT JOIN all_events e ON f.browser_id = e.browser_id
      AND f.date >= CAST(e.time AS DATE) - 1 AND f.date < CAST(e.time AS DATE)"""
_PERIOD = "window_days = 30 AND outcome_date <= DATE '2024-01-25'"


def labelled(spark, sf):
    rows = daily.visitor_views(pageviews(spark, sf)).select("browser_id", "date").distinct()
    out = outcomes.conversion_outcome(rows, event_table(spark, sf))
    return out.withColumn("window_days", F.lit(30))


@query(
    "profile_retrieval",
    f"""SELECT * FROM b_labelled WHERE {_PERIOD}
    AND (outcome_date >= DATE '2024-01-15' OR outcome IN ('conversion', 'shared_account_login'))""",
)
def profile_retrieval(spark, sf):
    history = labels_of(CONVERSION_LABELS, "positive")
    return packing.retrieve_profiles(
        labelled(spark, sf), "browser_id", 30, "2024-01-15", "2024-01-25", history
    )


@query(
    "latest_profile",
    f"""SELECT * FROM b_labelled WHERE {_PERIOD} AND outcome_date >= DATE '2024-01-15'
    QUALIFY rank() OVER (PARTITION BY browser_id ORDER BY date DESC) = 1""",
)
def latest_profile(spark, sf):
    return packing.retrieve_profiles(labelled(spark, sf), "browser_id", 30, "2024-01-15", "2024-01-25")


# ---- the user level, through the store ---------------------------------------------------------
USER_VERSION = "2.00"


_HISTORY_COLUMNS = {*STAT_COLUMNS, *PAIR_COLUMNS, *DIFF_COLUMNS}
TABLES["u_full"] = """SELECT s.* RENAME (as_of AS date), o.* EXCLUDE (user_id, date)
    FROM daily_sub_features s LEFT JOIN u_outcome o ON s.user_id = o.user_id AND s.as_of = o.date"""
TABLES["u_stored"] = f"""SELECT user_id, date, outcome, outcome_date,
    {_stored_sql(SPECS["u"], _HISTORY_COLUMNS | _profile_columns(SPECS["u"]))} FROM u_full"""


def user_store(spark, version=USER_VERSION):
    """A new store of user profiles."""
    return ProfileStore(spark, scratch_dir(spark, "user_profiles"), SPECS["u"], USER_WINDOW, version, dt.datetime(2024, 2, 1))


@query("user_backfill", "SELECT * FROM u_stored")
def user_backfill(spark, sf):
    """All days but the last in one pass; the resumed run adds the last day on its own and nothing else."""
    store, last = user_store(spark), dt.date.fromisoformat(LAST_DAY)
    # Versions and expiring users of a day are the same in any period, so both runs read one table of them.
    history = user_history(spark, sf, FIRST_DAY, LAST_DAY)

    def build(start, end):
        return user_rows(spark, sf, start, end, history)

    store.backfill(build, FIRST_DAY, last - dt.timedelta(1))
    if store.backfill(build, FIRST_DAY, LAST_DAY) != [(last, last)]:
        raise RuntimeError("the resumed run built more than the missing day")
    return _shown(packing.unpack_features(store.read(), store.spec), store.spec)
