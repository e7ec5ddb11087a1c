"""Token counts over message texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import tokens


def token_counts(df: DataFrame, column: str = "value") -> DataFrame:
    """How often each token occurs; rows without a text add none.

    Counts are combined before the shuffle, so a token that fills the input
    crosses it once per task. On a stream this is a running count.
    """
    return df.select(F.explode(tokens(F.col(column))).alias("value")).groupBy("value").agg(F.count("*").alias("count"))
