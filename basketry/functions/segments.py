"""RFM score arithmetic and the named segments."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Segment names.
CHAMPIONS = "Champions"
LOYAL = "Loyal"
BIG_SPENDERS = "Big Spenders"
NEW = "New"
AT_RISK = "At Risk"
HIBERNATING = "Hibernating"
NEEDS_ATTENTION = "Needs Attention"


def segment_of(r: Column, f: Column, m: Column) -> Column:
    """The first rule that holds; the thresholds are fixed values. A missing score meets no threshold."""
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), CHAMPIONS)
        .when((r >= 4) & (f >= 3) & (m >= 3), LOYAL)
        .when((r >= 3) & (m >= 4), BIG_SPENDERS)
        .when((r >= 4) & (f <= 2), NEW)
        .when((r <= 2) & ((f >= 3) | (m >= 3)), AT_RISK)
        .when((r <= 2) & (f <= 2) & (m <= 2), HIBERNATING)
        .otherwise(NEEDS_ATTENTION)
    )


def composite_score(r: Column, f: Column, m: Column) -> Column:
    """The three scores side by side as one number, recency first."""
    return (r * 100 + f * 10 + m).cast("int")
