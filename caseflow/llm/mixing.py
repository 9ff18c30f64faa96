"""Mixing sources to target weights by Sainte-Lague apportionment. DataFrame functions only.

A document's size is its number of words. Sources get target shares of all words by weight; no source gives more than
``most`` times what it has, and what that leaves over is shared again by weight. Equal blocks of ``block`` words are then
given to the sources by highest quotients target / 1, target / 3, target / 5, ..., and each source's blocks in the same
way to its shards, which are even parts of the source by a seeded hash of the ids. So each shard has a whole number of
blocks to give. A shard's documents in a seeded order form one stream of words, cut into blocks. The shard gives the
whole stream as often as its quota asks for, and for the rest a seeded run of its blocks.

No step holds a source in one task: shards have about ``shard_words`` words whatever the source's size, quotients are
ranked by a distributed sort, and quotas start from rounded shares, so that only the few seats which rounding leaves
over have to be ranked.

Defined results. A null or wordless text has size 0 and gives nothing. A null source is a source of its own, last in
order. Rows with equal ids stand next to each other, so equal rows may give different amounts; as a whole the result
does not depend on which is which. An empty table gives an empty result. Columns of the documents are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseflow.llm.tables import distinct_name, materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 16
SHARD_WORDS = 65_536
SEED = "mix"


def seeded(*parts: Column | str) -> Column:
    """60 bits of a seeded hash as a number."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def positions(df: DataFrame, order: list[Column], output: str) -> DataFrame:
    """Rows numbered from 0 in ``order``, by a distributed sort.

    What is broadcast is one number for each partition of the sort.
    """
    placed = materialize(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_at", 33)
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(sizes), "_part")
    return numbered.withColumn(output, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_before", "_at")


def apportion(df: DataFrame, group: list[str], tie: list[str], weight: str, seats: str, output: str) -> DataFrame:
    """Sainte-Lague: ``seats`` (equal in a group) given out in proportion to ``weight``; ties to the smaller ``tie`` (numbers).

    Rounded shares are at most half a seat a row away from the total. Which seats to add or take back follows from
    the quotients beside each row's rounded share; as many of them are listed as could be needed.
    """
    sums = df.groupBy(*group).agg(F.sum(weight).alias("_w"), F.count("*").alias("_rows"), F.max(seats).alias("_seats"))
    share = F.when(F.col("_w") > 0, F.col("_seats") * F.col(weight) / F.col("_w")).otherwise(0.0)
    based = df.join(materialize(sums, "sums"), group).withColumn("_base", F.floor(share + 0.5))
    open_ = based.groupBy(*group).agg((F.max("_seats") - F.sum("_base")).alias("_open"))
    based = materialize(based.join(materialize(open_, "open"), group), "shares")
    need = F.ceil(F.col(weight) / F.col("_w") * (F.abs("_open") + F.col("_rows"))) + 1
    need = F.when(F.col("_open") > 0, need).otherwise(F.least(need, F.col("_base")))
    listed = based.where("_open <> 0 AND _w > 0").withColumn("_k", F.explode(F.when(need > 0, F.sequence(F.lit(1), need.cast("int"))).otherwise(F.array().cast("array<int>"))))
    odd = F.when(F.col("_open") > 0, 2 * F.col("_base") + 2 * F.col("_k") - 1).otherwise(2 * F.col("_base") - 2 * F.col("_k") + 1)
    quotient = F.col(weight) / odd
    listed = listed.withColumn("_q", F.when(F.col("_open") > 0, -quotient).otherwise(quotient))
    sign = F.signum("_open").cast("long")  # seats are taken back from the larger tie first
    order = [*[F.col(c) for c in group], F.col("_q"), *[F.col(c) * sign for c in tie], F.col("_k")]
    ranked = positions(listed.select(*group, *tie, "_open", "_q", "_k"), order, "_rank")
    firsts = materialize(ranked.groupBy(*group).agg(F.min("_rank").alias("_first")), "firsts")
    chosen = ranked.join(firsts, group).where(F.col("_rank") - F.col("_first") < F.abs("_open"))
    change = chosen.groupBy(*group, *tie).agg(F.sum(F.signum("_open")).cast("long").alias("_change"))
    result = based.join(change, [*group, *tie], "left").withColumn(output, F.col("_base") + F.coalesce("_change", F.lit(0)))
    return result.select(*df.columns, output)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, sid, weight, source_size, target``: how many words each source is to give.

    ``sid`` numbers the sources by code point, null last; weights repeat in that order.
    """
    sources = positions(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), [F.col("source").asc_nulls_last()], "sid")
    weight = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    sources = materialize(sources.withColumn("weight", weight), "sources")
    room = F.col("source_size") * most
    total, all_weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    left, open_weights = total or 0, all_weights or 1
    while True:  # each round closes at least one more source
        full = F.col("weight") * float(left) / float(open_weights) > room
        capped, still = sources.agg(F.sum(F.when(full, room)), F.sum(F.when(~full, F.col("weight")))).first()
        before = (left, open_weights)
        left, open_weights = (total or 0) - (capped or 0), still or 1
        if (left, open_weights) == before:
            break
    target = F.when(full, room.cast("double")).otherwise(F.col("weight") * float(left) / float(open_weights))
    return materialize(sources.withColumn("target", target), "targets")


def mixture(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK, shard_words: int = SHARD_WORDS,
    seed: str = SEED, keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns of the documents (all by default) and how much of each the mix takes.

    Added last, in ``_mix`` (renamed if the name is taken): size, source_size, target, copies (whole texts), and the words from_1 to to_1 and from_2 to to_2
    (ends exclusive) that are taken once more.
    """
    keep = list(docs.columns) if keep is None else keep
    sized = docs.select(
        F.struct(*keep).alias("_row"), F.col("source"), F.col("doc_id").alias("_id"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    narrow = docs.select("source", F.col("doc_id").alias("_id"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    narrow = materialize(narrow, "sizes")
    targets = source_targets(narrow, weights, most)
    total = targets.agg(F.sum("source_size")).first()[0] or 0
    given = apportion(targets.withColumn("_all", F.lit(0)).withColumn("_n", F.lit((total + block // 2) // block)), ["_all"], ["sid"], "target", "_n", "blocks").drop("_all", "_n")
    given = materialize(given.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long")), "blocks")

    def placed(rows: DataFrame) -> DataFrame:
        known = given.withColumnRenamed("source", "_source")
        joined = rows.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        return joined.withColumn("_hash", seeded(seed, F.col("_id"))).withColumn("shard", F.pmod("_hash", "shards"))

    shards = placed(narrow).groupBy("sid", "shard").agg(F.sum("size").alias("words"), F.max("blocks").alias("blocks"))
    quotas = apportion(materialize(shards, "shards"), ["sid"], ["shard"], "words", "blocks", "quota")
    ask = F.least(F.col("quota") * block, F.col("words") * most)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("words") / block)).cast("long")
    start = F.pmod(F.shiftright(seeded(seed, F.col("sid"), F.col("shard")), 4), blocks) * block
    quotas = materialize(
        quotas.where("words > 0").withColumn("copies", F.floor(ask / F.col("words")).cast("int"))
        .withColumn("rest", ask - F.col("copies") * F.col("words")).withColumn("start", start)
        .select("sid", "shard", "words", "copies", "rest", "start"),
        "quotas",
    )
    stream = W.partitionBy("sid", "shard").orderBy("_hash", "_id", "size").rowsBetween(W.unboundedPreceding, 0)
    rows = placed(sized).withColumn("_end", F.sum("size").over(stream)).withColumn("_begin", F.col("_end") - F.col("size"))
    rows = rows.join(quotas, ["sid", "shard"], "left")

    def overlap(low: Column, high: Column, name: str) -> list[Column]:
        begin, end = F.greatest(low, F.col("_begin")), F.least(high, F.col("_end"))
        some = F.coalesce(begin < end, F.lit(False))
        return [F.when(some, x - F.col("_begin")).otherwise(0).alias(f"{part}_{name}") for part, x in (("from", begin), ("to", end))]

    turn = F.col("start") + F.col("rest")
    return rows.select(
        "_row.*",
        F.struct(
            "size", "source_size", "target", F.coalesce("copies", F.lit(0)).alias("copies"),
            *overlap(F.col("start"), F.least(turn, F.col("words")), "1"), *overlap(F.lit(0), turn - F.col("words"), "2"),
        ).alias(distinct_name(keep, "_mix")),
    )


def report(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for each document row."""
    m = mixture(docs, keep=["doc_id"], **options)  # its second column is _mix
    once = F.col("_mix.to_1") - F.col("_mix.from_1") + F.col("_mix.to_2") - F.col("_mix.from_2")
    return m.select("doc_id", "_mix.size", "_mix.source_size", "_mix.target", (F.col("_mix.copies") * F.col("_mix.size") + once).cast("long").alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: a row for each whole copy, and one for each part that is taken; columns as in ``docs``.

    Where there is a column ``n_chars``, it follows the text.
    """
    m, text = mixture(docs, **options), F.col("text")
    name, taken = m.columns[-1], distinct_name(m.columns, "_taken")
    words = F.regexp_extract_all("text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))

    def part(k: int) -> Column:
        low, high = F.col(f"{name}.from_{k}"), F.col(f"{name}.to_{k}")
        cut = F.array_join(F.slice(words, (low + 1).cast("int"), (high - low).cast("int")), "")
        return F.when(high - low == F.col(f"{name}.size"), text).when(high > low, cut)

    texts = F.concat(F.array_repeat(text, F.col(f"{name}.copies")), F.array_compact(F.array(part(1), part(2))))
    rows = m.where(F.col(f"{name}.size") > 0).withColumn(taken, F.explode(texts)).withColumn("text", F.col(taken))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)
