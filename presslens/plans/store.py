"""The profile store: packed day partitions that are filled, resumed, re-run and read for models.

A store holds the profiles of one level, one partition per day, window, set of aggregates and
pipeline version.  Rows of older versions may lack fields that a newer one expects; reading fills
them with the default of their set.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.plans import packing
from presslens.session import scratch_dir
from presslens.sources import sinks
from presslens.spec import PROFILE_KEYS, FeatureSpec

Day = dt.date | str
#: Profiles of a period, both days included, as wide rows.
Build = Callable[[dt.date, dt.date], DataFrame]


def _day(value: Day) -> dt.date:
    return dt.date.fromisoformat(str(value))


@dataclass(frozen=True)
class ProfileStore:
    spark: SparkSession
    path: str
    spec: FeatureSpec
    window_days: int
    version: str
    created_at: dt.datetime | None = None

    def _folder(self, day: dt.date) -> str:
        values = (day, self.window_days, ",".join(self.spec.aliases), self.version)
        keys = (f"{k}={str(v).replace(',', '%2C')}" for k, v in zip(PROFILE_KEYS, values, strict=True))
        return f"{self.path.rstrip('/')}/{'/'.join(keys)}"

    def missing(self, start: Day, end: Day) -> list[tuple[dt.date, dt.date]]:
        """Runs of days of the period that are not stored yet; looks at folder names only."""
        days = [_day(start) + dt.timedelta(k) for k in range((_day(end) - _day(start)).days + 1)]
        runs: list[tuple[dt.date, dt.date]] = []
        for day in days:
            if sinks.exists(self.spark, self._folder(day)):
                continue
            if runs and runs[-1][1] == day - dt.timedelta(1):
                runs[-1] = runs[-1][0], day
            else:
                runs.append((day, day))
        return runs

    def write(self, rows: DataFrame, start: Day, end: Day, stored: bool = False) -> int:
        """Pack wide rows and replace the days they belong to; days without rows are marked as done.

        The wide rows are written first: packing hundreds of columns in the plan that computes
        them makes one expression of everything.  ``stored`` says that they are read from a table
        already.  Days are dealt out before packing, because numbers are smaller than their texts.
        """
        wide = rows if stored else sinks.stored(rows, scratch_dir(self.spark, "wide"))
        created = None if self.created_at is None else F.lit(self.created_at).cast("timestamp_ntz")
        dealt = wide.hint("rebalance", "date")
        packed = packing.pack_features(dealt, self.spec, self.window_days, self.version, created)
        n = sinks.write_profiles(packed, self.path, rebalance=False)
        for first, last in self.missing(start, end):
            for k in range((last - first).days + 1):
                sinks.make_folder(self.spark, self._folder(first + dt.timedelta(k)))
        return n

    def backfill(self, build: Build, start: Day, end: Day, again: bool = False) -> list[tuple[dt.date, dt.date]]:
        """Fill the days of a period and return the runs of days that were built.

        Each run is one pass over its days and the window before them.  Days that are stored are
        left as they are, so a broken run goes on where it stopped; ``again`` rewrites the
        period, and no other day.
        """
        runs = [(_day(start), _day(end))] if again else self.missing(start, end)
        for first, last in runs:
            self.write(build(first, last), first, last)
        return runs

    def read(self) -> DataFrame:
        """Packed rows of this window, these aggregates and every version."""
        rows = self.spark.read.parquet(self.path)
        return rows.where(
            (F.col("window_days") == self.window_days) & (F.col("feature_aggregation_functions") == ",".join(self.spec.aliases))
        )

    def profiles(self, start: Day, end: Day, history_labels: Sequence[str] = (), deduplicate: bool | None = None) -> DataFrame:
        """Profiles with outcomes in a period, unpacked; ``history_labels`` as in ``retrieve_profiles``.

        An outcome comes after its profile, so partitions after the period are not read.
        """
        rows = self.read().where(F.col("date") <= F.lit(str(end)).cast("date"))
        found = packing.retrieve_profiles(rows, self.spec.id_column, self.window_days, start, end, history_labels, deduplicate)
        return packing.unpack_features(found, self.spec)
