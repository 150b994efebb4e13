"""Row limits that are features: a development sample, a preview, an ad-hoc cap."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.contracts import ADHOC_ROWS, PREVIEW_ROWS


def sample_rows(df: DataFrame, order: str, rows: int | None) -> DataFrame:
    """The ``rows`` lowest by ``order`` (a per-task top-k, then a merge); all if ``None``."""
    return df if rows is None else df.orderBy(order).limit(rows)


def preview(df: DataFrame, *order: str, rows: int = PREVIEW_ROWS) -> DataFrame:
    """First rows; give an ``order`` to make them the same on every run."""
    return (df.orderBy(*order) if order else df).limit(rows)


def ad_hoc(spark: SparkSession, query: str, rows: int = ADHOC_ROWS, **frames: DataFrame) -> DataFrame:
    """Run a user's SQL text over the catalog and ``{named}`` frames, capped at ``rows``."""
    return spark.sql(query, **frames).limit(rows)
