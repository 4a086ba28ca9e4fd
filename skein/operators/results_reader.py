"""Reading published outputs back, as a consumer of the result topics would.

A file-backed topic is a folder of parquet files with a ``value`` column
(JSON text).  Its "partition" is the number in the part file's name and the
"offset" the row index inside the file (the ``_metadata`` columns of the
parquet source).  Kafka
topics, when the connector is present, give the same columns natively.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.schemas import CONSUMED_MESSAGE, UPSERT_KEY
from skein.session import fresh_path


def read_topics(spark: SparkSession, topics: dict[str, str], *, kafka: dict | None = None) -> DataFrame:
    """``topic, partition, offset, value`` for every message of every topic.

    ``topics`` maps topic name -> folder.  Messages without a value
    (tombstones) are skipped.  At least one topic is required.
    """
    if not topics:
        raise ValueError("at least one topic must be given")
    if kafka:
        raw = (
            spark.read.format("kafka")
            .option("kafka.bootstrap.servers", kafka["bootstrap_servers"])
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", "earliest")
            .load()
        )
        msgs = raw.select(
            "topic",
            "partition",
            "offset",
            F.col("value").cast("string").alias("value"),
        )
    else:
        parts = [
            spark.read.parquet(path).select(
                F.lit(name).alias("topic"),
                F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).try_cast("int").alias("partition"),
                F.col("_metadata.row_index").alias("offset"),
                F.col("value").cast("string").alias("value"),
            )
            for name, path in topics.items()
        ]
        msgs = reduce(DataFrame.unionByName, parts)
    return msgs.filter(F.col("value").isNotNull())


def number_messages(msgs: DataFrame, key: list[str]) -> DataFrame:
    """Add ``topic_message_number``: 1, 2, ... per topic in the order of the
    natural ``key`` (JSON fields of the value), then of the value, so equal
    contents are numbered alike however they were written.

    One range shuffle; each sorted range is stored with a running id, and its
    topics' counts (one row per range and topic) give the numbers to add.
    """
    spark = msgs.sparkSession
    names = [f"_k{i}" for i in range(len(key))]
    rows = msgs.select("*", F.json_tuple("value", *key).alias(*names))
    order = ["topic", *names, "value"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order, "partition", "offset")
    path = fresh_path(spark, "numbered")
    ranged.drop(*names).withColumns({"_part": F.spark_partition_id(), "_id": F.monotonically_increasing_id()}).write.parquet(path)
    stored = spark.read.parquet(path)
    counts = stored.groupBy("topic", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy("topic").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.select("topic", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_add"))
    out = stored.join(start, ["topic", "_part"]).withColumn("topic_message_number", F.col("_id") + F.col("_add"))
    return out.to(CONSUMED_MESSAGE)


def read_results(spark: SparkSession, topics: dict[str, str], kafka: dict | None = None) -> DataFrame:
    return number_messages(read_topics(spark, topics, kafka=kafka), UPSERT_KEY)


def dedupe_results(msgs: DataFrame, key: list[str]) -> DataFrame:
    """Drop repeats of an at-least-once output by its natural key (keeps the
    first by topic order)."""
    parsed = msgs.withColumn("_k", F.struct(*[F.get_json_object("value", f"$.{k}").alias(k) for k in key]))
    first = F.min(F.struct("partition", "offset", "value"))
    return parsed.groupBy("topic", "_k").agg(first.alias("_m")).select("topic", "_m.partition", "_m.offset", "_m.value")
