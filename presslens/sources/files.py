"""Daily log files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.session import require_utc

# File kinds, their columns, and which of them must be there.
REQUIRED = {
    "pageviews": (
        "user_id", "browser_id", "subscriber", "derived_referer_medium", "category", "time",
        "session_id", "user_agent",
    ),
    "pageviews_time_spent": ("user_id", "browser_id", "timespent"),
    "commerce": ("browser_id", "user_id", "time", "step"),
}
OPTIONAL = {"pageviews": ("tags",), "pageviews_time_spent": (), "commerce": ()}
FILE_LAYOUT = "{kind}/{kind}_{stamp}.csv*"
STAMP = "[_=]([0-9]{8})(?=[./]|$)"


def date_range(start: dt.date, end: dt.date) -> list[dt.date]:
    return [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]


def file_date():
    """Day in the name of the file a row was read from."""
    return F.to_date(F.regexp_extract(F.input_file_name(), STAMP, 1), "yyyyMMdd")


def read_day_csv(
    spark: SparkSession,
    folder: str,
    kind: str,
    dates: Iterable[dt.date],
    sep: str = ";",
    missing: str = "error",
    ignore_empty_browser_id: bool = False,
    layout: str = FILE_LAYOUT,
    session_column: str = "session_id",
) -> DataFrame | None:
    """Rows of the log files of the given days, with ``date`` from the file name.

    Plain and gzip files are found by the same pattern; columns are taken by header name, so files
    may order them differently or have further ones: files with equal headers are read together.
    ``session_column`` names the session column of the log.
    ``missing`` is ``error`` (every day must have a file), ``skip`` (days without one are left
    out), or ``none`` (like skip, and None when no day has one, for the optional time-spent log).
    ``event_id`` numbers rows in file order.
    """
    if kind not in REQUIRED:
        raise ValueError(f"kind must be one of {sorted(REQUIRED)}, got {kind!r}")
    require_utc(spark)
    stamps = [d.strftime("%Y%m%d") for d in dates]
    if missing == "error":
        paths = [f"{folder}/{layout.format(kind=kind, stamp=s)}" for s in stamps]
    else:
        paths = [f"{folder}/{layout.format(kind=kind, stamp='{' + ','.join(stamps) + '}')}"]
        if missing == "none" and not _any_match(spark, paths[0]):
            return None
    groups: dict[str, list[str]] = {}
    for path in _files(spark, paths):
        groups.setdefault(_first_line(spark, path), []).append(path)
    parts = [_same_header(spark, found, kind, sep, ignore_empty_browser_id, session_column) for found in groups.values()]
    raw = parts[0]
    for part in parts[1:]:
        raw = raw.unionByName(part, allowMissingColumns=True)
    raw = raw.withColumn("event_id", F.monotonically_increasing_id())
    names = [*REQUIRED[kind], *[c for c in OPTIONAL[kind] if c in raw.columns]]

    def typed(name: str):
        if name == "time":
            return F.to_timestamp("time").cast("timestamp_ntz").alias("time")
        if name == "timespent":
            return F.col("timespent").cast("long").alias("timespent")
        # Empty fields are read as null, the log means an empty text.
        return F.coalesce(F.col(name), F.lit("")).alias(name)

    return raw.select("date", "event_id", *[typed(n) for n in names])


def _same_header(
    spark: SparkSession, paths: list[str], kind: str, sep: str, ignore_empty_browser_id: bool, session_column: str
) -> DataFrame:
    """The columns a kind needs from files with one header."""
    # Without a schema every column is text, named by the header; only one line is read for it.
    raw = spark.read.option("header", True).option("sep", sep).option("escape", '"').csv(paths)
    if session_column != "session_id" and session_column in raw.columns:
        raw = raw.drop("session_id").withColumnRenamed(session_column, "session_id")
    if "browser_id" not in raw.columns and ignore_empty_browser_id:
        raw = raw.withColumn("browser_id", F.lit(""))
    absent = [c for c in REQUIRED[kind] if c not in raw.columns]
    if absent:
        raise ValueError(f"{kind} log lacks the columns {absent}")
    names = [*REQUIRED[kind], *[c for c in OPTIONAL[kind] if c in raw.columns]]
    return raw.select(file_date().alias("date"), *names)


def _glob(spark: SparkSession, pattern: str) -> list:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return list(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or [])


def _any_match(spark: SparkSession, pattern: str) -> bool:
    return bool(_glob(spark, pattern))


def _files(spark: SparkSession, patterns: list[str]) -> list[str]:
    """Files of the patterns and of the folders they match; a pattern without a match is an error."""
    found = []
    for pattern in patterns:
        matches = _glob(spark, pattern)
        if not matches:
            raise FileNotFoundError(f"PATH_NOT_FOUND: {pattern}")
        for status in matches:
            inner = _glob(spark, f"{status.getPath()}/*") if status.isDirectory() else [status]
            found += [s.getPath().toString() for s in inner if s.isFile() and s.getLen() and s.getPath().getName()[0] not in "._"]
    return found


def _first_line(spark: SparkSession, path: str) -> str:
    """The header of a file, unpacked if its name says so; nothing beyond it is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    stream = place.getFileSystem(conf).open(place)
    try:
        source = codec.createInputStream(stream) if codec else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def read_jsonl(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON lines with a declared schema (arrays stay arrays)."""
    return spark.read.schema(schema).json(path)


def stored_period(spark: SparkSession, paths: str | list[str], column: str = "date") -> tuple:
    """First and last value of a column of stored Parquet files; raises when there is none.

    Dates, numbers and flags are answered from the footers of the files (``PushedAggregation`` in the
    plan), so no data page is read.  Other types read their one column.  The settings this
    takes belong to a session of its own; the caller's stays as it is.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    first, last = period_plan(own, paths, column).first()
    if first is None:
        raise ValueError(f"no {column} in {paths}: there is no period to process")
    return first, last


def period_plan(spark: SparkSession, paths: str | list[str], column: str) -> DataFrame:
    return spark.read.parquet(*([paths] if isinstance(paths, str) else paths)).agg(F.min(column).alias("first"), F.max(column).alias("last"))
