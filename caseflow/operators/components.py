"""Connected components of reply links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.operators.joins import skewed_join
from caseflow.session import materialize


def parent_links(messages: DataFrame, use_responses: bool = True) -> DataFrame:
    """``tweet_id -> parent`` where the parent is a row of the table; else parent is null.

    A message whose named parent is not in the table, or that names none, may be named in the response
    list of another one; that one is then its parent (the lowest id if there are several).
    """
    links = messages.select("tweet_id", F.col("in_response_to_tweet_id").alias("parent"))
    known = messages.select(F.col("tweet_id").alias("parent"), F.lit(True).alias("known"))
    # rows without a parent carry no key; they keep out of the join
    linked = skewed_join(links.where("parent IS NOT NULL"), known.distinct(), "parent", "left")
    found = links.where("parent IS NULL").unionByName(
        linked.select("tweet_id", F.when(F.col("known"), F.col("parent")).alias("parent"))
    )
    if not use_responses:
        return found
    # a list counts where its own message is in the table, which it is by standing there
    named = response_links(messages).groupBy(F.col("child").alias("tweet_id")).agg(F.min("by").alias("by"))
    return found.join(named, "tweet_id", "left").select("tweet_id", F.coalesce("parent", "by").alias("parent"))


def response_links(messages: DataFrame) -> DataFrame:
    """``by, child``: which other messages each message lists as its answers."""
    listed = messages.where(F.col("response_tweet_id").isNotNull()).select(
        F.col("tweet_id").alias("by"), F.explode(F.split("response_tweet_id", r"\s*,\s*")).alias("child")
    )
    return listed.select("by", F.expr("try_cast(child AS BIGINT)").alias("child")).where("child IS NOT NULL AND child <> by")


def _are_stars(links: DataFrame) -> bool:
    """Whether every higher end has one lower end, and no end is both."""
    if not links.groupBy("high").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return False
    return links.join(links.select(F.col("high").alias("low")), "low", "left_semi").isEmpty()


def contract(links: DataFrame) -> DataFrame:
    """``node, lowest``: for every end ``a``, ``b`` of a link, the lowest end of its connected component.

    Alternates two steps until the links are stars. A large-star step ties the higher neighbours of every node to the
    lowest one beside it, a small-star step does so with the lower neighbours; a chain or hub of n nodes takes in the order of
    log(n) rounds. Minima combine on the map side and are stored before they are joined, so that a hub's links meet
    a plain table and adaptive execution can split them.
    """
    ends = links.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()
    stored = materialize(ends, "links")
    while not _are_stars(stored):
        both = stored.select(F.col("high").alias("node"), F.col("low").alias("beside"))
        both = both.unionByName(stored.select(F.col("low").alias("node"), F.col("high").alias("beside")))
        least = materialize(both.groupBy("node").agg(F.least(F.col("node"), F.min("beside")).alias("least")), "least")
        large = both.where("beside > node").join(least, "node").select(F.col("beside").alias("high"), F.col("least").alias("low"))
        large = materialize(large.distinct(), "links")
        least = materialize(large.groupBy("high").agg(F.min("low").alias("least")), "least")
        met = large.join(least, "high")
        rest = met.where("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low"))
        stored = materialize(least.withColumnRenamed("least", "low").unionByName(rest).distinct(), "links")
    stars = stored.select(F.col("high").alias("node"), F.col("low").alias("lowest"))
    return stars.unionByName(stars.select(F.col("lowest").alias("node"), "lowest").distinct())


def _cycle_names(links: DataFrame, found: DataFrame) -> DataFrame:
    """``lowest, name`` for components without a start: the lowest id on a cycle.

    Following pointers as many steps as the largest of them has messages leads every message onto its cycle, and all of a
    cycle is reached; each round doubles the steps.
    """
    moving = materialize(links.join(found, "tweet_id").select("tweet_id", F.col("parent").alias("pointer"), "lowest"), "cycles")
    size = moving.groupBy("lowest").count().agg(F.max("count")).first()[0] or 0
    for _ in range(size.bit_length()):
        ahead = moving.select(F.col("tweet_id").alias("pointer"), F.col("pointer").alias("next"))
        moving = skewed_join(moving, ahead, "pointer").select("tweet_id", F.col("next").alias("pointer"), "lowest")
        moving = materialize(moving, "cycles")
    return moving.groupBy("lowest").agg(F.min("pointer").alias("name"))


def reply_components(messages: DataFrame, use_responses: bool = True) -> DataFrame:
    """``tweet_id, component_id``: connected components of reply links, named by the message that starts the thread.

    All links are followed at once, in either direction. ``use_responses=False`` follows only what each message answers; by default the
    response lists are links as well. A component of several threads takes the lowest start; where no
    message starts a thread, since the links go round, it takes the lowest id on the cycle. A message without links is a component of its own.
    """
    links = materialize(parent_links(messages, use_responses), "parents")
    ends = links.where("parent IS NOT NULL").select(F.col("tweet_id").alias("a"), F.col("parent").alias("b"))
    if use_responses:
        known = messages.select(F.col("tweet_id").alias("child")).distinct()
        listed = skewed_join(response_links(messages), known, "child", "left_semi")
        ends = ends.unionByName(listed.select(F.col("by").alias("a"), F.col("child").alias("b")))
    stars = contract(ends).withColumnRenamed("node", "tweet_id")
    placed = links.join(stars, "tweet_id", "left").select("tweet_id", "parent", F.coalesce("lowest", "tweet_id").alias("lowest"))
    placed = materialize(placed, "components")
    start = F.min(F.when(F.col("parent").isNull(), F.col("tweet_id")))
    names = materialize(placed.groupBy("lowest").agg(start.alias("name")), "names")
    found = names.where("name IS NOT NULL")
    if not names.where("name IS NULL").isEmpty():
        around = placed.join(names.where("name IS NULL").select("lowest"), "lowest")
        found = found.unionByName(_cycle_names(around.select("tweet_id", "parent"), around.select("tweet_id", "lowest")))
    return skewed_join(placed, found, "lowest").select("tweet_id", F.col("name").alias("component_id"))
