"""Rows dealt out by number, where each costs much more than its bytes show."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` by its keys in as many partitions as shuffles have: a small file of texts to parse is one task otherwise.  Windows and
    aggregations by these keys and others need no shuffle of their own."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
