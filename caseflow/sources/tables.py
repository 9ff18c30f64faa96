"""Readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow import schemas


def _csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, quoted line breaks and doubled quotes; the schema is given."""
    return (
        spark.read.schema(schema)
        .options(header=True, multiLine=True, escape='"', mode="PERMISSIVE")
        .csv(path)
    )


def read_messages_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw messages. Parent ids may be written as decimals (``123.0``) and are made whole."""
    loose = T.StructType([
        T.StructField(f.name, T.StringType() if f.name == "in_response_to_tweet_id" else f.dataType)
        for f in schemas.MESSAGES_RAW
    ])
    parent = F.expr("try_cast(try_cast(in_response_to_tweet_id AS DECIMAL(38,1)) AS BIGINT)")
    return _csv(spark, path, loose).withColumn("in_response_to_tweet_id", parent)


def read_golden_csv(spark: SparkSession, path: str) -> DataFrame:
    """Benchmark rows. An empty cell is an empty text, as a row without labels has it."""
    return _csv(spark, path, schemas.GOLDEN).na.fill("")


def read_labels_csv(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.LABELS)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Parquet. Partition ``assignment`` by ``split``: most readers want one split."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header. Arrays are written as ``a|b``."""
    flat = [
        F.array_join(F.col(f"`{f.name}`").cast("array<string>"), "|").alias(f.name)
        if isinstance(f.dataType, T.ArrayType) else F.col(f"`{f.name}`")
        for f in df.schema
    ]
    df.select(*flat).write.mode(mode).options(header=True, escape='"').csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
