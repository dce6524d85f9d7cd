"""Business rules that turn values into labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Outcome labels and their sign.
CHURN_LABELS = {"renewal": "positive", "churn": "negative"}
CONVERSION_LABELS = {
    "no_conversion": "negative",
    "shared_account_login": "positive",
    "conversion": "positive",
}
# Payment statuses that count as a payment.
ACCEPTED_STATUSES = ("paid", "prepaid", "family", "upgrade")
# Commerce funnel steps.
COMMERCE_STEPS = ("checkout", "payment", "purchase", "refund")
# Probability limits of the audience segments.
MEDIUM_LIMIT = 0.2
LOW_LIMIT = 0.1


def labels_of(labels: dict[str, str], sign: str) -> list[str]:
    return [name for name, value in labels.items() if value == sign]


def segment_for(outcome: Column, probability: Column) -> Column:
    """Audience segment of one prediction; below every limit the outcome itself is the segment."""
    return (
        F.when(outcome == "conversion", F.lit("high_conversion"))
        .when(probability >= MEDIUM_LIMIT, F.lit("medium_conversion"))
        .when(probability >= LOW_LIMIT, F.lit("low_conversion"))
        .otherwise(outcome)
    )


def web_access_level(web: Column, standard: Column, club: Column) -> Column:
    """-1 without web access, otherwise how many of web / standard / club are included."""
    parts = [c.cast("int") for c in (web, standard, club)]
    return F.when(web != 1, F.lit(-1)).otherwise(parts[0] + parts[1] + parts[2])
