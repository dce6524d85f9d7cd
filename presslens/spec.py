"""Names of the feature columns, generated from the key lists and aggregation aliases."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

# The key lists that get a column each.
REFERER_MEDIUMS = ("direct", "email", "external", "internal", "search", "social")
CATEGORIES = (
    "", "blog", "ekonomika", "hlavna", "karikatury", "komentare", "kultura", "nezaradene",
    "pageview", "rodina-a-vztahy", "slovensko", "sport", "svet", "veda", "zdravie",
)
DEVICE_TYPES = ("desktop", "mobile", "tablet")
HOURS = tuple(range(24))
HOUR_RANGES = tuple((h, h + 4) for h in range(0, 24, 4))
WEEKDAYS = tuple(range(7))
# The keys that stored profiles are replaced by.
PROFILE_KEYS = ("date", "window_days", "feature_aggregation_functions", "pipeline_version")

# Window variants and how their columns are named.
FULL, RECENT_HALF, OLDER_HALF = "", "_first_window_half", "_last_window_half"
WINDOW_SUFFIXES = (RECENT_HALF, OLDER_HALF, FULL)


def sanitize(name: str | None) -> str:
    """Column-name form of a key: dash and blank to underscore, dots dropped, None to ''."""
    return "" if name is None else name.translate(str.maketrans("- ", "__", "."))


def hour_column(hour: int) -> str:
    return f"pageviews_{hour}h"


def range_column(first: int, last: int, prefix: str = "pageviews") -> str:
    return f"{prefix}_{first}h_{last}h"


def change_column(name: str) -> str:
    return f"relative_{name}_change_first_and_second_half"


HOUR_COLUMNS = tuple(hour_column(h) for h in HOURS)
RANGE_COLUMNS = tuple(range_column(a, b) for a, b in HOUR_RANGES)
PVS_COLUMNS = tuple(range_column(a, b, "pvs") for a, b in HOUR_RANGES)


@dataclass(frozen=True)
class Derived:
    """A ratio of two rolled columns."""

    name: str
    numerator: str
    denominator: str


@dataclass(frozen=True)
class FeatureSpec:
    """All expected feature names of one record level (``user`` or ``browser``)."""

    level: str = "user"
    aliases: tuple[str, ...] = ("avg",)
    device_brands: tuple[str, ...] = ()
    mediums: tuple[str, ...] = REFERER_MEDIUMS
    categories: tuple[str, ...] = CATEGORIES

    def __post_init__(self) -> None:
        if self.level not in ("user", "browser"):
            raise ValueError(f"unknown record level {self.level!r}")

    @property
    def id_column(self) -> str:
        return f"{self.level}_id"

    # ---- rolled columns -------------------------------------------------------------------
    def pivot_columns(self) -> dict[str, list[str]]:
        return {
            "referer_mediums": [sanitize(f"referer_mediums_{k}") for k in self.mediums],
            "categories": [sanitize(f"categories_{k}") for k in self.categories],
        }

    def rolled_sources(self) -> dict[str, str]:
        """Feature stem -> column of the day frame it is rolled from."""
        stems = {
            "pageviews": "pageviews",
            "timespent": "timespent",
            "direct_visit": "sessions_without_ref",
            "visit": "sessions",
        }
        if self.level == "browser":
            stems |= {c: c for c in ("commerce_checkouts", "commerce_payments")}
        for names in self.pivot_columns().values():
            stems |= {n: n for n in names}
        return stems | {n: n for n in PVS_COLUMNS}

    def derived(self) -> list[Derived]:
        out = []
        for a in self.aliases:
            out += [
                Derived(f"pageviews_per_visit_{a}", f"pageviews_{a}", f"visit_{a}"),
                Derived(f"visits_per_day_active_{a}", f"visit_{a}", "days_active_count"),
                Derived(f"direct_visits_share_{a}", f"direct_visit_{a}", f"visit_{a}"),
                Derived(f"timespent_per_visit_{a}", f"timespent_{a}", f"visit_{a}"),
                Derived(f"timespent_per_pageview_{a}", f"timespent_{a}", f"pageviews_{a}"),
            ]
        return out

    def windowed_stems(self) -> list[str]:
        """Names that exist for the full window and both halves, derived ratios included."""
        rolled = [f"{s}_{a}" for s in self.rolled_sources() for a in self.aliases]
        weekdays = [f"dow_{i}_{a}" for i in WEEKDAYS for a in self.aliases]
        return rolled + weekdays + ["days_active_count"] + [d.name for d in self.derived()]

    # ---- feature sets as stored -------------------------------------------------------------
    def numeric_columns(self) -> list[str]:
        names = []
        for a in self.aliases:
            names += [f"{s}_{a}" for s in ("pageviews", "visit", "direct_visit", "timespent")]
            names += [f"{d}_device_{a}" for d in DEVICE_TYPES]
        names += [d.name for d in self.derived()] + ["days_active_count", "days_since_last_active"]
        if self.level == "browser":
            names.append("shared_account_logins_past_30_days")
        return sorted(names)

    def pivot_features(self, normalized: bool = False) -> dict[str, list[str]]:
        tail = "_normalized" if normalized else ""
        return {
            kind: sorted(f"{n}_{a}{tail}" for n in names for a in self.aliases)
            for kind, names in self.pivot_columns().items()
        }

    def time_features(self, normalized: bool = False) -> dict[str, list[str]]:
        tail = "_normalized" if normalized else ""
        return {
            "hour_ranges": sorted(f"{n}_{a}{tail}" for n in PVS_COLUMNS for a in self.aliases),
            "days_of_week": sorted(f"dow_{i}_{a}{tail}" for i in WEEKDAYS for a in self.aliases),
        }

    def window_variants(self) -> list[str]:
        stems = [n for n in self.numeric_columns() if n != "days_since_last_active"]
        for group in (*self.pivot_features().values(), *self.time_features().values()):
            stems += group
        return sorted(
            v for s in stems for v in (s + RECENT_HALF, s + OLDER_HALF, change_column(s))
        )

    def categorical_columns(self) -> list[str]:
        return ["day_of_week"] + (["device", "os", "browser"] if self.level == "browser" else [])

    def bool_columns(self) -> list[str]:
        own = ["is_active_on_date"]
        return own + ([f"is_{d}" for d in DEVICE_TYPES] if self.level == "browser" else [])

    def device_columns(self) -> list[str]:
        if self.level == "browser":
            return []
        brands = sorted({sanitize(b) for b in self.device_brands})
        return [f"{b}_device_brand_sum" for b in brands] + [f"{d}_device_sum" for d in DEVICE_TYPES]

    def feature_sets(self) -> dict[str, tuple[str, list[str]]]:
        """Stored set name -> (default text for missing values, column names)."""
        sets: dict[str, tuple[str, list[str]]] = {"numeric_columns": ("0.0", self.numeric_columns())}
        for kind, names in self.pivot_features().items():
            sets[f"profile_numeric_columns_from_json_fields__{kind}"] = ("0.0", names)
        for kind, names in self.time_features().items():
            sets[f"time_based_columns__{kind}"] = ("0.0", names)
        sets["categorical_columns"] = ("", sorted(self.categorical_columns()))
        sets["bool_columns"] = ("False", sorted(self.bool_columns()))
        sets["numeric_columns_with_window_variants"] = ("0.0", self.window_variants())
        if self.level == "user":
            sets["device_based_columns"] = ("0.0", sorted(self.device_columns()))
            sets["numeric_columns_subscriptions_base"] = ("0.0", sorted(SUBSCRIPTION_BASE))
            sets["numeric_columns_subscriptions_derived"] = ("0.0", sorted(SUBSCRIPTION_DERIVED))
            sets["categorical_columns_subscriptions"] = ("", sorted(SUBSCRIPTION_CATEGORICAL))
        return sets

    def stored_columns(self) -> list[str]:
        return [f"features__{name}" for name in self.feature_sets()]

    def numeric_features(
        self, normalization: str = "ignore", context: bool = False, payments: bool = False
    ) -> list[str]:
        """Model inputs that are numbers; ``normalization`` is ignore, add or replace."""
        if normalization not in ("ignore", "add", "replace"):
            raise ValueError(f"unknown normalization handling {normalization!r}")
        plain = [*self.pivot_features().values(), *self.time_features().values()]
        shares = [*self.pivot_features(True).values(), *self.time_features(True).values()]
        names = set(self.numeric_columns()) | set(self.window_variants()) | set(self.device_columns())
        if normalization != "replace":
            names |= _flat(plain)
        if normalization != "ignore":
            names |= _flat(shares)
        if self.level == "user":
            names |= set(SUBSCRIPTION_BASE) | set(SUBSCRIPTION_DERIVED)
        if context:
            names |= {"article_pageviews_count", "sum_paid", "avg_price"}
        if payments:
            names |= {"clv"} | ({"days_since_last_subscription"} if self.level == "browser" else set())
        return sorted(names)

    def categorical_features(self) -> list[str]:
        extra = SUBSCRIPTION_CATEGORICAL if self.level == "user" else ()
        return sorted([*self.categorical_columns(), *extra])

    def bool_features(self) -> list[str]:
        extra = SUBSCRIPTION_BOOL if self.level == "user" else ()
        return sorted([*self.bool_columns(), *extra])


def _flat(groups: Iterable[Iterable[str]]) -> set[str]:
    return {name for group in groups for name in group}


# Subscription features of the user level.
SUBSCRIPTION_BASE = (
    "total_amount", "average_amount", "count_subs", "paid_subs", "free_subs",
    "number_of_days_since_the_first_paid_sub", "average_gap", "max_gap",
    "total_days_paid_sub", "total_days_free_sub", "upgraded_subs", "discount_subs",
)
#: What the two newest subscriptions of a user are compared by: the kind of input that either
#: side is, and the kind their change is (None: the change is no input).
COMPARED = {
    "amount": ("number", "number"),
    "length": ("number", "number"),
    "is_recurrent": ("flag", "text"),
    "is_recurrent_charge": ("flag", "text"),
    "web_access_level": ("text", "text"),
    "sub_print_access": ("text", "text"),
    "sub_print_friday_access": ("text", "text"),
    "payment_status": ("text", None),
}


def compared_columns(kind: str) -> tuple[str, ...]:
    """Names of the last, previous and diff columns that are inputs of a kind."""
    of_side = {"last": 0, "previous": 0, "diff": 1}
    return tuple(f"{c}_{side}" for c, kinds in COMPARED.items() for side, at in of_side.items() if kinds[at] == kind)


SUBSCRIPTION_DERIVED = compared_columns("number")
SUBSCRIPTION_CATEGORICAL = compared_columns("text")
SUBSCRIPTION_BOOL = compared_columns("flag")
