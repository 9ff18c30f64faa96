"""The test tables seen as a support-message table.

A conversation's turns become messages: each answers the turn before it, assistants are
brand accounts, users are customers, system turns have an outbound author of their own. In every seventh
conversation each turn is another brand's, so that shared conversations occur too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions.rules import RulePack

# Words that do occur in the test prose, under the taxonomy's tags.
STANDIN_PACK = RulePack(
    (
        ("account_access_security", r"\b(from|with)\b"),
        ("unauthorized_nonprime_charge", r"\b(by|as)\b"),
        ("prime_billing_cancellation", r"\b(that|this)\b"),
        ("order_cancellation", r"\b(for|on)\b"),
        ("return_wrong_damaged", r"\b(is|was)\b"),
        ("refund_request", r"\b(der|die|und)\b"),
        ("address_redirect", r"\b(of|to)\b"),
        ("delivery_issue", r"\b(the|and)\b"),
    )
)

FIRST_SECOND = 1_509_494_400  # 2017-11-01 00:00:00 UTC
BRANDS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    tweet_id = F.col("conv_id") * 1000 + F.col("turn")
    inbound = F.col("role") == "user"
    shift = F.when(F.col("conv_id") % 7 == 0, F.col("turn")).otherwise(F.lit(0))
    brand = (F.col("conv_id") + shift) % BRANDS
    sent = F.timestamp_seconds(F.lit(FIRST_SECOND) + tweet_id)
    return turns.select(
        tweet_id.alias("tweet_id"),
        F.when(inbound, F.concat(F.lit("cust_"), F.col("conv_id").cast("string")))
        .when(F.col("role") == "system", "system")
        .otherwise(F.concat(F.lit("brand_"), brand.cast("string"))).alias("author_id"),
        inbound.alias("inbound"),
        F.date_format(sent, "EEE MMM dd HH:mm:ss Z yyyy").alias("created_at"),
        "text",
        F.lit(None).cast("string").alias("response_tweet_id"),
        F.when(F.col("turn") > 0, tweet_id - 1).alias("in_response_to_tweet_id"),
    )


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("tweet_id"), F.col("conv_id").alias("component_id"))


def with_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages with their component, as the brand and conversation jobs read them."""
    return messages_raw(spark, sf_dir).withColumn("component_id", F.floor(F.col("tweet_id") / 1000))


def flawed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with components, where some texts are null or blank and some dates cannot be read."""
    n = F.col("tweet_id")
    return with_components(spark, sf_dir).withColumns({
        "text": F.when(n % 41 != 0, F.when(n % 43 == 0, F.lit(" \t ")).otherwise(F.col("text"))),
        "created_at": F.when(n % 47 == 0, F.lit("yesterday")).otherwise(F.col("created_at")),
    })


HUB = 3_000


def linked_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages with links of all kinds.

    In every fifth conversation a turn names the next one in its response list, beside one that is not there, and the next
    one names nothing. The first turns of every eleventh answer one hub. In every thirteenth the first two turns
    answer each other.
    """
    n, conv = F.col("tweet_id"), F.floor(F.col("tweet_id") / 1000)
    turn, listed = n % 1000, conv % 5 == 1
    ring, to_hub = (conv % 13 == 5) & (turn == 0), (conv % 11 == 3) & (turn == 0) & (n != HUB)
    parent = F.when(ring, n + 1).when(to_hub, F.lit(HUB)).when(~listed | (conv % 13 == 5), F.col("in_response_to_tweet_id"))
    return messages_raw(spark, sf_dir).withColumns({
        "in_response_to_tweet_id": parent.cast("long"),
        "response_tweet_id": F.when(listed, F.concat((n + 1).cast("string"), F.lit(" , "), (n + 500).cast("string"), F.lit(",x"))),
    })
