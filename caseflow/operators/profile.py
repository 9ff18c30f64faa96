"""Profile of a message table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.functions import text as t


def shape(df: DataFrame) -> DataFrame:
    """Row and column count; the rows are counted where they lie."""
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))


def dtypes(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes


def null_counts(df: DataFrame) -> DataFrame:
    """``column_name, nulls`` for every column from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return counts.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (column_name, nulls)")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key."""
    groups = df.groupBy(key).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_keys"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows equal to an earlier one in all columns; nulls count as equal.

    Grouping by a wide hash first would save shuffle bytes but could count a collision,
    so rows are grouped by their values; copies are already merged on the map side.
    """
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.col(col))


def blank_texts(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(t.is_blank(F.col("text"))).alias("blank_texts"))


def top_authors(messages: DataFrame, inbound: bool = False, n: int = 25) -> DataFrame:
    return (
        messages.where(F.col("inbound") == inbound).groupBy("author_id")
        .agg(F.count("*").alias("messages"))
        .orderBy(F.desc("messages"), "author_id").limit(n)
    )


def first_authors(messages: DataFrame, n: int = 10) -> DataFrame:
    """Authors of the first customer messages in the table's id order."""
    return messages.where("inbound").select("tweet_id", "author_id").orderBy("tweet_id").limit(n)


def root_messages(messages: DataFrame) -> DataFrame:
    return messages.where("inbound AND in_response_to_tweet_id IS NULL")
