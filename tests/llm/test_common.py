import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from skein.llm import common
from skein.llm.common import append


def test_a_worker_keeps_no_memory_of_a_finished_task(spark):
    def resident() -> float:
        with open("/proc/self/smaps_rollup") as f:
            return sum(int(line.split()[1]) for line in f if line.startswith(("Pss_Anon:", "Pss_Shmem:"))) / 1024

    def start():
        import os

        def step(ids):
            before = resident()
            # Arrays that go again; a few that stay lie among them until the process ends.
            made = [np.ones(20_000, dtype=np.uint8) for _ in range(8000)]
            np._kept_for_test = [*getattr(np, "_kept_for_test", []), *made[::200], np.ones(20_000, dtype=np.uint8)]
            del made
            return [pa.array([before] * len(ids)), pa.array([os.getpid()] * len(ids))]

        return step

    fields = [T.StructField("before", T.DoubleType()), T.StructField("worker", T.LongType())]
    seen: dict[int, list[float]] = {}
    for _ in range(12):
        r = append(spark.range(1, numPartitions=1), ["id"], start, fields).collect()[0]
        seen.setdefault(r.worker, []).append(r.before)
    again = [x for x in seen.values() if len(x) > 1]
    assert again
    assert all(x[1] - x[0] < 60 for x in again), seen


def test_the_driver_gives_back_what_its_jvm_has_freed(spark):
    jvm = spark.sparkContext._jvm
    pid = jvm.java.lang.ProcessHandle.current().pid()

    def resident() -> float:
        with open(f"/proc/{pid}/smaps_rollup") as f:
            return sum(int(line.split()[1]) for line in f if line.startswith(("Pss_Anon:", "Pss_Shmem:"))) / 1024

    common.released(spark)
    # Memory outside the heap; a few pieces that stay lie among those that go again.
    made = [jvm.java.util.zip.Deflater() for _ in range(600)]
    for i, d in enumerate(made):
        if i % 30:
            d.end()
    before = resident()
    common.released(spark)
    if hasattr(common, "trimmed_jvm") and not common.trimmed_jvm(spark):
        pytest.skip("this JVM has no command for it")
    assert before - resident() > 40, before
