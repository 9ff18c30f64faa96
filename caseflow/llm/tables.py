"""Reading tables and cutting lineage for the operators and queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.session import materialize

__all__ = ["distinct_name", "materialize", "table", "text_key"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: Column) -> Column:
    """64 bits of a text: with the id, a key that equal rows share. Null has a key of its own."""
    return F.coalesce(F.xxhash64(text), F.lit(0))


def distinct_name(columns: list[str], name: str) -> str:
    """``name``, or with underscores until no column is called so (Spark ignores case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name

BIT_WORDS = 1 << 17


def _marked(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``df`` with ``_mark``: false only where no row of ``wanted`` has the row's ``key``.

    The keys of ``wanted`` are folded into 2**23 bits. That table has at most 2**17 rows of two numbers
    however many keys there are, so it can always be broadcast, and ``df`` is not shuffled.
    """
    at = F.pmod(F.xxhash64(key), F.lit(BIT_WORDS * 64))
    bits = (
        wanted.select(at.alias("_at"))
        .groupBy(F.expr("cast(_at div 64 AS int)").alias("_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(_at % 64 AS int))")).alias("_bits"))
    )
    placed = df.withColumn("_at", at).withColumn("_word", F.expr("cast(_at div 64 AS int)"))
    mark = F.expr("_bits IS NOT NULL AND shiftright(_bits, cast(_at % 64 AS int)) & 1L = 1L")
    return placed.join(F.broadcast(bits), "_word", "left").withColumn("_mark", mark).drop("_at", "_word", "_bits")


def likely_rows(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``wanted``, and perhaps some others. Nothing is shuffled."""
    return _marked(df, key, wanted).where("_mark").drop("_mark")


def without_rows(df: DataFrame, id_col: str, text_col: str, unwanted: DataFrame) -> DataFrame:
    """``df`` without the rows whose id and text key are in ``unwanted`` (columns ``id``, ``key``), copies of a row once.

    ``unwanted`` must also list, with ``again`` true, the keys of rows that stand in ``df`` more than once. Only
    rows that may be listed are shuffled.
    """
    unwanted = materialize(unwanted, "unwanted")
    rows = df.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"))
    marked = _marked(rows, "id", unwanted)
    listed = marked.where("_mark").drop("_mark").dropDuplicates(["id", "key"])
    left = listed.join(unwanted.where("NOT again").select("id", "key").distinct(), ["id", "key"], "left_anti")
    return marked.where("NOT _mark").select("row.*").unionByName(left.select("row.*"))
