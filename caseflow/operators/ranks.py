"""Positions and top-n within groups that stay balanced when one group is huge.

A plain ``row_number`` sends a whole group to one task. The functions here give the same
numbers, yet no task gets more than a slice of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseflow.functions import text as t
from caseflow.session import materialize


def _ranges(df: DataFrame, order_by: list[str]) -> DataFrame:
    """``df`` cut into ranges of about equally many rows in an order, stored, with the range's number in ``_part``.

    Rows that are equal in the whole order stand in one range, so the order should end in an id.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by)
    return materialize(cut.withColumn("_mid", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()), "ranges")


def numbered(df: DataFrame, order_by: list[str], output: str) -> DataFrame:
    """0-based number of each row in the order of the whole table.

    A row's number is its place in its range after the rows of earlier ranges; one number a range is broadcast.
    """
    placed = _ranges(df, order_by)
    before = W.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row a range
    starts = placed.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_mid").alias("_first"))
    starts = starts.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    number = F.col("_mid") - F.col("_first") + F.col("_before")
    return placed.join(F.broadcast(starts), "_part").withColumn(output, number).drop("_part", "_mid", "_first", "_before")


def ordered_position(df: DataFrame, key: str, order_by: list[str], output: str) -> DataFrame:
    """0-based position of each row within its key, in an order that ends in an id.

    The table is cut into ranges of key and order, so a key with many rows stands in several ranges, however its
    rows are ordered. Rows are numbered within their range; a key that goes on from an earlier range adds its rows there.
    At most one key goes on across each border, so these shifts are fewer than the ranges, and are broadcast.
    """
    placed = _ranges(df, [key, *order_by]).drop("_mid")
    before = W.partitionBy("_k").orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    sizes = placed.groupBy(F.col(key).alias("_k"), F.col("_part").alias("_p")).agg(F.count("*").alias("_n"))
    shift = sizes.select("_k", "_p", F.sum("_n").over(before).alias("_shift")).where("_shift > 0")
    within = W.partitionBy("_part", key).orderBy(*order_by)
    same = F.col(key).eqNullSafe(F.col("_k")) & (F.col("_part") == F.col("_p"))
    return (
        placed.withColumn("_rn", F.row_number().over(within)).join(F.broadcast(shift), same, "left")
        .withColumn(output, F.col("_rn") - 1 + F.coalesce("_shift", F.lit(0))).drop("_part", "_rn", "_k", "_p", "_shift")
    )


def hashed_position(
    df: DataFrame, keys: list[str], row_id: str, seed: int, output: str, digits: int = 4
) -> DataFrame:
    """1-based position within ``keys`` in the order of a seeded hash of ``row_id``.

    Rows are spread over ``16 ** digits`` hash slices per key and ranked within a slice;
    the rows in lower slices are added. Slices are even however uneven the keys are.
    """
    hashed = df.withColumn("_h", t.seeded_hash(seed, F.col(row_id))).withColumn(
        "_slice", F.substring("_h", 1, digits)
    )
    before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    shift = (
        hashed.groupBy(*keys, "_slice").agg(F.count("*").alias("_n"))
        .select(*keys, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    within = W.partitionBy(*keys, "_slice").orderBy("_h", row_id)
    # keys may be null: a null key is a group of its own and must find its shift
    shift = shift.select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)], F.col("_slice").alias("_s"), "_shift")
    same = F.col("_slice") == F.col("_s")
    for n, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{n}"))
    return (
        hashed.withColumn("_rn", F.row_number().over(within)).join(shift, same)
        .withColumn(output, F.col("_rn") + F.col("_shift"))
        .drop("_h", "_slice", "_rn", "_shift", "_s", *[f"_k{n}" for n in range(len(keys))])
    )


def top_n(
    df: DataFrame,
    keys: list[str],
    order_by: list[Column | str],
    n: int,
    spread: str,
    output: str = "rank",
    salts: int = 64,
) -> DataFrame:
    """The first ``n`` rows of each key, numbered from 1.

    The first pass keeps n rows per key and salt, so the second one gets at most
    ``n * salts`` rows of a key, even of one that holds a third of the table.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    first = W.partitionBy(*keys, "_salt").orderBy(*order_by)
    second = W.partitionBy(*keys).orderBy(*order_by)
    return (
        salted.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= n)
        .withColumn(output, F.row_number().over(second)).where(F.col(output) <= n)
        .drop("_salt", "_rn")
    )


def quantile_bins(df: DataFrame, col: str, n: int = 256) -> Column:
    """Number of a value's bin, for up to ``n`` bins that hold about equally many rows of ``df``.

    Borders are approximate quantiles, at most ``n`` numbers; bins rise with the values, so anything exact can
    be counted within a bin and summed over lower bins. One far outlier moves no border.
    """
    borders = sorted(set(df.approxQuantile(col, [k / n for k in range(1, n)], 0.25 / n)))
    return F.size(F.filter(F.array(*[F.lit(float(b)) for b in borders]).cast("array<double>"), lambda b: b <= F.col(col)))
