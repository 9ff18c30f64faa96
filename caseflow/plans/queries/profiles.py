"""Table and brand profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.operators import brands, profile
from caseflow.plans.queries import base
from caseflow.session import scratch_path
from caseflow.sources import standin, tables

PROFILED = ("conversations", "documents", "events", "orders", "lineitem", "customer")


def table_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        profile.shape(standin.table(spark, sf_dir, name)).withColumn("table_name", F.lit(name))
        for name in PROFILED
    ]
    return reduce(DataFrame.unionByName, parts)


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_counts(standin.messages_raw(spark, sf_dir))


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey", "events": "user_id"}
    parts = [
        profile.duplicate_keys(standin.table(spark, sf_dir, t), k).withColumn("table_name", F.lit(t))
        for t, k in keys.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        profile.duplicate_rows(df).withColumn("table_name", F.lit(name))
        for name, df in (
            ("lineitem", standin.table(spark, sf_dir, "lineitem")),
            ("documents", standin.table(spark, sf_dir, "documents").select("text", "lang")),
        )
    ]
    return reduce(DataFrame.unionByName, parts)


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(standin.table(spark, sf_dir, "events"), "event_type")


def blank_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.blank_texts(standin.messages_raw(spark, sf_dir))


def top_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_authors(standin.messages_raw(spark, sf_dir))


def first_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.first_authors(standin.messages_raw(spark, sf_dir))


def root_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.root_messages(standin.messages_raw(spark, sf_dir)).select("tweet_id", "author_id")


def brand_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brands.brand_profile(standin.with_components(spark, sf_dir), with_diversity=False)


def brand_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brands.brand_diversity(brands.brand_texts(standin.with_components(spark, sf_dir)))


def diversity_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published sample of each brand's distinct texts, here with 20 texts a brand."""
    return brands.diversity_sample(brands.brand_texts(standin.with_components(spark, sf_dir)), 20).select("brand", F.md5("norm").alias("norm_md5"))


def source_round_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages through CSV, JSON and a partitioned table; each must come back whole."""
    raw = standin.messages_raw(spark, sf_dir)
    path = scratch_path(spark, "round-trip")
    tables.write_csv(raw, f"{path}/csv")
    tables.write_json(raw, f"{path}/json")
    tables.write_table(raw, f"{path}/table", ("inbound",))
    back = {
        "csv": tables.read_messages_csv(spark, f"{path}/csv"),
        "json": spark.read.schema(raw.schema).json(f"{path}/json"),
        "table": tables.read_table(spark, f"{path}/table"),
    }
    parts = [
        df.agg(
            F.count("*").alias("rows"), F.sum("tweet_id").alias("id_sum"),
            F.sum(F.length("text")).cast("bigint").alias("text_chars"),
            F.count("in_response_to_tweet_id").alias("parents"), F.count_if("inbound").alias("customers"),
        ).withColumn("form", F.lit(name))
        for name, df in back.items()
    ]
    return reduce(DataFrame.unionByName, parts)


QUERIES = {f.__name__: f for f in (
    table_shapes, null_counts, duplicate_keys, duplicate_rows, value_counts, blank_texts, top_authors,
    first_authors, root_messages, brand_profile, brand_diversity, diversity_sample, source_round_trips,
)}

ORACLES = {
    "table_shapes": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows, "
        f"(SELECT count(*) FROM (DESCRIBE {t})) AS columns" for t in PROFILED
    ),
    "null_counts": f"WITH {base.MSG}" + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, CAST(count(*) - count({expr}) AS BIGINT) AS nulls FROM raw"
        for name, expr in (
            ("tweet_id", "tweet_id"), ("author_id", "author_id"), ("inbound", "inbound"), ("created_at", "sent"),
            ("text", "text"), ("response_tweet_id", "CAST(NULL AS VARCHAR)"), ("in_response_to_tweet_id", "parent"),
        )
    ),
    "duplicate_keys": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) - count(DISTINCT {k}) AS duplicate_keys FROM {t}"
        for t, k in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("events", "user_id"))
    ),
    "duplicate_rows": """
        SELECT 'lineitem' AS table_name, (SELECT count(*) FROM lineitem)
               - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicate_rows
        UNION ALL SELECT 'documents', (SELECT count(*) FROM documents)
               - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents))""",
    "value_counts": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "blank_texts": f"WITH {base.MSG} SELECT count(*) FILTER (regexp_matches(text, '^\\s*$')) AS blank_texts FROM raw",
    "top_authors": f"""WITH {base.MSG} SELECT author_id, count(*) AS messages FROM raw WHERE NOT inbound
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25""",
    "first_authors": f"WITH {base.MSG} SELECT tweet_id, author_id FROM raw WHERE inbound ORDER BY 1 LIMIT 10",
    "root_messages": f"WITH {base.MSG} SELECT tweet_id, author_id FROM raw WHERE inbound AND parent IS NULL",
    "brand_profile": f"""WITH {base.MSG},
        bc AS (SELECT author_id AS brand, component_id, count(*) AS replies FROM raw WHERE NOT inbound GROUP BY 1, 2),
        cs AS (SELECT component_id, count(*) AS size, count(*) FILTER (inbound) AS customers FROM raw GROUP BY 1),
        m AS (SELECT brand, count(*) AS n_conversation_components, CAST(sum(customers) AS BIGINT) AS n_customer_messages,
              CAST(sum(replies) AS BIGINT) AS n_brand_replies,
              round(100.0 * count(*) FILTER (customers > 0) / count(*), 2) AS pct_with_brand_response,
              quantile_cont(size, 0.5) AS median_length, round(avg(size), 3) AS mean_length,
              round(100.0 * count(*) FILTER (size > 2) / count(*), 2) AS pct_multi_turn,
              count(*) FILTER (customers > 0) AS n_usable_cases
              FROM bc JOIN cs USING (component_id) GROUP BY 1),
        tx AS (SELECT brand, {base.sql_normal("text")} AS norm FROM raw JOIN bc USING (component_id) WHERE inbound),
        d AS (SELECT brand, count(DISTINCT norm) AS n_distinct_messages,
              round(100 * (1 - count(DISTINCT norm) / count(*)), 2) AS duplicate_pct FROM tx GROUP BY 1)
        SELECT * FROM m LEFT JOIN d USING (brand)""",
    "diversity_sample": f"""WITH {base.MSG},
        bc AS (SELECT DISTINCT author_id AS brand, component_id FROM raw WHERE NOT inbound),
        tx AS (SELECT DISTINCT brand, {base.sql_normal("text")} AS norm FROM raw JOIN bc USING (component_id) WHERE inbound)
        SELECT brand, md5(norm) AS norm_md5 FROM tx WHERE norm <> ''
        QUALIFY row_number() OVER (PARTITION BY brand ORDER BY md5('42:' || norm), norm) <= 20""",
    "source_round_trips": f"WITH {base.MSG}" + " UNION ALL ".join(
        f"""SELECT '{form}' AS form, count(*) AS rows, CAST(sum(tweet_id) AS BIGINT) AS id_sum,
        CAST(sum(length(text)) AS BIGINT) AS text_chars, count(parent) AS parents,
        count(*) FILTER (inbound) AS customers FROM raw""" for form in ("csv", "json", "table")
    ),
}
