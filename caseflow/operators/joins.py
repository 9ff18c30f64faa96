"""Equi-joins in which one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1024


def skewed_join(
    rows: DataFrame, table: DataFrame, key: str, how: str = "inner", salts: int | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """``rows`` joined to ``table`` on one key, with the rows of frequent keys spread over ``salts`` places.

    The ``HOT_KEYS`` most frequent keys of ``rows`` are salted by a hash of the whole row, and their rows of ``table`` are
    copied once a salt; any other key has at most one in ``HOT_KEYS`` of the rows. Only the list of frequent keys is broadcast.
    There is one path for all sizes. ``salts`` is the session's number of shuffle partitions unless given. ``how`` is inner, left,
    left_semi or left_anti; a null key matches nothing. ``counts`` may bring the rows of each key (``key, _n``) if they are known.
    """
    salts = salts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if counts is None:
        counts = rows.groupBy(key).agg(F.count("*").alias("_n"))
    counts = counts.where(F.col(key).isNotNull())
    hot = counts.orderBy(F.desc("_n"), key).limit(HOT_KEYS).select(key, F.lit(salts).alias("_salts"))
    spread = F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(*rows.columns), F.lit(salts))).otherwise(F.lit(0))
    left = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", spread.cast("int")).drop("_salts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    right = table.join(F.broadcast(hot), key, "left").withColumn("_salt", copies).drop("_salts")
    return left.join(right, [key, "_salt"], how).drop("_salt")
