"""Places of regular-expression matches in texts, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GROUP = 256


def with_matches(df: DataFrame, text: str, name: str, pattern: str, before: int = 0) -> DataFrame:
    """``name``: the leftmost non-overlapping matches as an array of ``start, end, value, before``.

    Places are code points, ends exclusive; ``before`` holds up to so many characters between the match and the
    one before it. Lengths of what lies between matches are summed in groups, so that a text with very many
    matches costs little more than in proportion. Texts without a match are only searched once.
    """
    hit = F.col(text).rlike(pattern)
    none = F.array().cast("array<string>")
    df = df.withColumn("_m", F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("_g", F.when(F.size("_m") > 0, F.split(text, pattern, -1)).otherwise(none))
    df = df.withColumn("_z", F.arrays_zip(F.col("_m").alias("m"), F.slice("_g", F.lit(1), F.size("_m")).alias("g")))
    df = df.withColumn("_l", F.transform("_z", lambda z: F.length(z["m"]) + F.length(z["g"])))
    add, zero = (lambda a, x: a + x), F.lit(0)
    groups = F.when(F.size("_l") > 0, F.sequence(zero, F.floor((F.size("_l") - 1) / GROUP).cast("int"))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("_t", F.transform(groups, lambda b: F.aggregate(F.slice("_l", b * GROUP + 1, GROUP), zero, add)))
    # columns named twice on purpose: Spark then computes them once and not for every element
    df = df.withColumn("_b", F.transform("_t", lambda x, b: F.aggregate(F.slice("_t", F.lit(1), b), zero, add)))

    def end(x: Column, i: Column) -> Column:
        low = F.floor(i / GROUP).cast("int")
        return F.get("_b", low) + F.aggregate(F.slice("_l", low * GROUP + 1, i - low * GROUP + 1), zero, add)

    df = df.withColumn("_e", F.when(F.size("_b") > 0, F.transform("_l", end)).otherwise(F.array().cast("array<int>")))
    rows = F.arrays_zip(F.col("_e").alias("e"), F.col("_z").alias("z"))
    found = F.transform(
        rows,
        lambda r: F.struct(
            (r["e"] - F.length(r["z"]["m"])).alias("start"), r["e"].alias("end"), r["z"]["m"].alias("value"),
            (F.right(r["z"]["g"], F.lit(before)) if before else F.lit("")).alias("before"),
        ),
    )
    return df.withColumn(name, found).drop("_m", "_g", "_z", "_l", "_t", "_b", "_e")


def tagged(found: Column, kind: str, place: int) -> Column:
    """Matches as ``start, place, end, kind``, which sort by start, then by the kinds' order."""
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(place).alias("place"), m["end"].alias("end"), F.lit(kind).alias("kind")))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of tagged matches in order, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def apart(found: Column, spans: Column) -> Column:
    """The matches that overlap none of the tagged ``spans``."""
    return F.filter(found, lambda m: ~F.exists(spans, lambda s: (m["start"] < s["end"]) & (s["start"] < m["end"])))
