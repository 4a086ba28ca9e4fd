"""Result sinks.

* append (typed rows or JSON strings): the file sink, exactly-once per
  checkpoint through its metadata log.
* upsert: update-mode changelog written by ``foreachBatch``, one folder per
  micro-batch id, overwritten on retry, so a replayed batch never
  duplicates; every row carries its ``version`` (the batch id), the JSON key
  and the JSON value.
* :func:`compact` keeps the latest version per key, which is what a reader
  of an upsert topic keeps.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skein.config import EngineConfig
from skein.functions.jsonfmt import result_json, upsert_key_json
from skein.operators.quality import judged
from skein.schemas import RESULT, RESULT_COLUMNS, UPSERT_KEY

CHANGELOG = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        *RESULT.fields,
        T.StructField("version", T.LongType()),
    ]
)


def _trigger(writer, trigger):
    if trigger == "available_now":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    if trigger:
        return writer.trigger(processingTime=trigger)
    return writer


def start_append(
    results: DataFrame,
    *,
    path: str | None = None,
    checkpoint: str,
    emit: str = "row",
    trigger: str | None = "available_now",
    query_name: str | None = None,
    kafka: dict | None = None,
) -> StreamingQuery:
    """Closed windows only, one row (or one JSON string) per window.

    Files (``path``): exactly-once through the sink's metadata log.  Kafka
    (``kafka={"bootstrap_servers", "topic"}``, needs the connector on the
    classpath): JSON values, at-least-once; the rows carry their natural key
    (window bounds + manufacturer) so a reader can drop repeats.
    """
    if kafka:
        writer = (
            results.select(result_json().alias("value"))
            .writeStream.outputMode("append")
            .format("kafka")
            .option("kafka.bootstrap.servers", kafka["bootstrap_servers"])
            .option("topic", kafka["topic"])
            .option("checkpointLocation", checkpoint)
        )
        if query_name:
            writer = writer.queryName(query_name)
        return _trigger(writer, trigger).start()
    out = results.select(result_json().alias("value")) if emit == "json" else results
    writer = (
        out.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger).start()


def start_split(
    events: DataFrame, cfg: EngineConfig, *, path: str, checkpoint: str, trigger: str | None = "available_now", query_name: str | None = None
) -> StreamingQuery:
    """Accepted and rejected events of one scan, as the two partitions (``outcome``) of one file sink.

    A micro-batch's files of both kinds enter the sink's metadata log in one
    commit: a reader sees both or none, and a retried batch leaves no repeat.
    """
    kind = F.when(F.col("reason").isNull(), F.lit("accepted")).otherwise(F.lit("rejected"))
    writer = (
        judged(events, cfg)
        .withColumn("outcome", kind)
        .writeStream.outputMode("append")
        .format("parquet")
        .partitionBy("outcome")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger).start()


def read_split(spark: SparkSession, path: str, schema: T.StructType, accepted: bool) -> DataFrame:
    """One side of :func:`start_split`; the other's files are not read.  ``schema``: that of the events."""
    names = [f.name for f in schema.fields]
    whole = T.StructType([*schema.fields, T.StructField("reason", T.StringType()), T.StructField("outcome", T.StringType())])
    rows = spark.read.schema(whole).parquet(path).where(F.col("outcome") == ("accepted" if accepted else "rejected"))
    return rows.select(*names) if accepted else rows.select(*names, "reason")


def changelog_rows(batch: DataFrame, version: int) -> DataFrame:
    return batch.select(
        upsert_key_json().alias("key"),
        result_json().alias("value"),
        *RESULT_COLUMNS,
        F.lit(version).cast("long").alias("version"),
    )


def start_upsert(
    results: DataFrame,
    *,
    path: str | None = None,
    checkpoint: str,
    trigger: str | None = "available_now",
    query_name: str | None = None,
    kafka: dict | None = None,
) -> StreamingQuery:
    """Every changed key of every micro-batch, versioned by batch id.

    Files: one folder per batch id, overwritten if the batch is retried.
    Kafka: JSON key + JSON value per changed key (a compacted topic keeps the
    latest value per key).
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = changelog_rows(batch, batch_id)
        if kafka:
            (
                rows.select("key", "value")
                .write.format("kafka")
                .option("kafka.bootstrap.servers", kafka["bootstrap_servers"])
                .option("topic", kafka["topic"])
                .save()
            )
            return
        rows.drop("version").write.mode("overwrite").parquet(f"{path}/version={batch_id}")

    writer = (
        results.writeStream.outputMode("update")
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger).start()


def publish_changelog(kafka: dict):
    """A writer of batches of results as keyed JSON messages."""

    def publish(rows: DataFrame, batch_id: int) -> None:
        keyed = rows if "key" in rows.columns else rows.select(F.lit(None).cast("string").alias("key"), "*")
        keyed = keyed if "value" in keyed.columns else keyed.select("key", result_json().alias("value"))
        write_messages(keyed.select("key", "value"), kafka=kafka)

    return publish


def read_changelog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHANGELOG).parquet(path)


def compact(changelog: DataFrame, key: list[str] | None = None, version: str = "version") -> DataFrame:
    """Latest version per key (``key``, ``version`` unique per row).

    A key changes at most once per micro-batch and only while its window is
    open, so each key group holds a handful of rows: the shuffle by key
    carries no hot group.
    """
    key = key or UPSERT_KEY
    w = Window.partitionBy(*key).orderBy(F.col(version).desc())
    return changelog.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def compact_output(spark: SparkSession, path: str, keep: bool = False) -> DataFrame:
    """Compaction job of an upsert output: what :func:`read_current` gives becomes the new base.

    The base of the versions up to N is written beside the versions
    (``<path>_bases/upto=N``), then named in ``<path>_manifest``; readers
    take the latest named base and the versions after it, so a failed job
    changes nothing.  Without ``keep``, older bases and the versions within
    the new base are then deleted.  Run it between the stream's batches or
    beside it: versions that aren't complete yet are left alone.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [f.getPath() for f in files.listStatus(folder) if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    versions = sorted(int(p.getName().split("=")[1]) for p in done if p.getName().startswith("version="))
    upto, base = max(versions, default=None), _base(spark, path)
    if upto is None or (base is not None and base >= upto):
        return read_current(spark, path)
    current = read_current(spark, path, upto)
    current.write.mode("overwrite").parquet(f"{path}_bases/upto={upto}")
    spark.range(1).select(F.lit(upto).cast("long").alias("upto")).write.mode("append").parquet(f"{path}_manifest")
    if not keep:
        gone = [f"{path}/version={v}" for v in versions] + ([f"{path}_bases/upto={base}"] if base is not None else [])
        for old in gone:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(old), True)
    return read_current(spark, path)


def _base(spark: SparkSession, path: str) -> int | None:
    """The last version within the newest base; None without one."""
    try:
        return spark.read.schema("upto long").parquet(f"{path}_manifest").agg(F.max("upto")).first()[0]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def read_current(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """Latest row per key of an upsert output: its newest base and the versions after it."""
    log, base = read_changelog(spark, path), _base(spark, path)
    if upto is not None:
        log = log.where(F.col("version") <= upto)
    if base is None:
        return compact(log)
    # Old versions are skipped as folders: the version is the partition column.
    rows = spark.read.schema(CHANGELOG).parquet(f"{path}_bases/upto={base}").unionByName(log.where(F.col("version") > base))
    return compact(rows)


def write_messages(messages: DataFrame, *, path: str | None = None, kafka: dict | None = None) -> None:
    """Batch write of messages (``value``, and ``key`` where there is one): events or results."""
    if kafka:
        (
            messages.select(*[c for c in ("key", "value") if c in messages.columns])
            .write.format("kafka")
            .option("kafka.bootstrap.servers", kafka["bootstrap_servers"])
            .option("topic", kafka["topic"])
            .save()
        )
        return
    messages.write.mode("append").parquet(path)
