"""Message numbering and reading: each against a brute-force answer on small inputs."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skein.operators.results_reader import number_messages, read_results


def test_message_numbers_match_row_number(spark, workdir):
    for name, n, parts in (("a", 300, 3), ("b", 50, 2)):
        value = F.format_string('{"window_start":"%03d","window_end":"x","manufacturer_id":%d}', F.col("id") % 100, F.col("id"))
        spark.range(n).select(value.alias("value")).repartition(parts).write.parquet(f"{workdir}/{name}")
    got = read_results(spark, {"a": f"{workdir}/a", "b": f"{workdir}/b"})
    order = [F.get_json_object("value", f"$.{k}") for k in ("window_start", "window_end", "manufacturer_id")]
    want = got.withColumn("rn", F.row_number().over(Window.partitionBy("topic").orderBy(*order, "value")))
    assert want.filter(F.col("rn") != F.col("topic_message_number")).count() == 0
    assert got.count() == 350 and dict(got.dtypes)["partition"] == "int"


def test_numbers_do_not_depend_on_the_files(spark):
    rows = [(t, f'{{"k":{i % 7}}}', i % 3, i) for t in "ab" for i in range(40)]
    msgs = spark.createDataFrame(rows, "topic string, value string, partition int, offset long")
    one, two = (number_messages(m, ["k"]) for m in (msgs.coalesce(1), msgs.repartition(9, "offset")))
    assert sorted((r.topic, r.value, r.topic_message_number) for r in one.collect()) == sorted(
        (r.topic, r.value, r.topic_message_number) for r in two.collect()
    )


def test_reader_requires_topics(spark):
    with pytest.raises(ValueError):
        read_results(spark, {})


def test_reader_skips_tombstones(spark, workdir):
    spark.createDataFrame([("k1", '{"a":1}'), ("k2", None), ("k3", '{"a":3}')], "key string, value string").coalesce(1).write.parquet(
        f"{workdir}/upserts"
    )
    got = read_results(spark, {"iot_aggregates_upsert": f"{workdir}/upserts"})
    assert [(r.value, r.topic_message_number, r.partition, r.offset) for r in got.orderBy("offset").collect()] == [
        ('{"a":1}', 1, 0, 0),
        ('{"a":3}', 2, 0, 2),
    ]
