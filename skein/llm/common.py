"""What the operators of this subpackage share: documents, stored intermediates, words as arrays.

A document table has ``doc_id`` and ``text``; operators name their own result
columns and replace an input column of the same name.  A null text counts as
an empty one.
"""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.session import fresh_path

#: White space that parts words, and the separators' complement as a byte table.
SPACE = r"[\x20\x09-\x0D]+"
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Bytes of words made of letters and digits (any byte of a non-ASCII character counts).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

#: Texts handled at once by the array code, in bytes (a longer text is handled alone).
CHUNK = 2 << 20

#: Rows that go to Python, or come from it, at once.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


def stored(df: DataFrame, *name: str, **options: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read again: cuts the lineage.  ``options``: the writer's."""
    spark = df.sparkSession
    path = fresh_path(spark, "llm", *name)
    df.write.options(**options).parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    read._stored_at = path
    return read


def discarded(df: DataFrame) -> None:
    """Delete the table behind a result of :func:`stored` that nothing reads any more; call it once what was made
    from it is stored itself."""
    path = getattr(df, "_stored_at", None)
    if path is None:
        raise ValueError("not a stored table")
    hadoop = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(hadoop, True)


def trimmed(collect: bool = True) -> None:
    """Give memory that this Python process has freed back to the system: the C library's allocator and Arrow's keep
    what many arrays of middle size leave behind, hundreds of MB after a model has been fitted."""
    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def trimmed_jvm(spark: SparkSession) -> bool:
    """:func:`trimmed` for the driver's JVM: what its compiler, its threads and the codecs have freed outside the heap
    is given back to the system.  False where the JVM has no command for it (others than HotSpot, older ones)."""
    jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    args = array(jvm.java.lang.Object, 4)
    args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    args[2], args[3] = array(jvm.java.lang.Object, 0), array(jvm.java.lang.String, 0)
    try:
        # The server's own class is not open to callers, its interface is.
        methods = jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods()
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        next(m for m in methods if m.getName() == "invoke").invoke(server, args)
    except Py4JError:
        return False
    return True


def released(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps, and of the driver's freed memory.

    Spark deletes them once the driver's JVM has collected the plans that made
    them, which by itself may take half an hour; a job of many steps would
    hold all of theirs on disk at a time.
    """
    trimmed()
    if spark.sparkContext is not None:
        spark.sparkContext._jvm.System.gc()
        trimmed_jvm(spark)


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id's text modulo ``mod``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def share(column: Column, salt: int = 0) -> Column:
    """A hash of the value as a number in [0, 1), the same in every run."""
    return F.pmod(F.xxhash64(column, F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)


def ship(spark: SparkSession) -> None:
    """Make the session ready for Python stages: send this package to the workers, once, and bound the batches."""
    # Texts are long rows: unless the session says otherwise, a batch has a tenth of Spark's usual number.
    if spark.conf.get(BATCH, "10000") == "10000":
        spark.conf.set(BATCH, "1000")
    sc = spark.sparkContext
    if getattr(sc, "_skein_sent", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="skein-py-"), "skein_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._skein_sent = True


def append(
    df: DataFrame,
    inputs: list[str],
    start: Callable[[], Callable],
    fields: list[T.StructField],
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` (default: all columns) with ``fields`` appended, computed on Arrow batches.

    ``start()`` runs once in each task and returns a function of the input
    columns' arrays that returns one array per field.
    """
    ship(df.sparkSession)
    names = [f.name for f in fields]
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    # An input that is kept goes to Python once.
    more = [c for c in inputs if c not in kept]
    work = df.select(*[F.col(f"`{c}`") for c in [*kept, *more]])
    schema = T.StructType([work.schema[c] for c in kept] + fields)
    n, at = len(kept), [[*kept, *more].index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, batch, made = start(), None, None
        # An executor keeps more workers than it has tasks, and each of them has its turn.
        trimmed(collect=False)
        for batch in batches:
            made = step(*[batch.columns[i] for i in at])
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *made], names=[*batch.schema.names[:n], *names])
        del step, batch, made
        trimmed(collect=False)

    return work.mapInArrow(run, schema)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins (and the last ends); null as empty."""
    column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts with ``size`` bytes at most, or of one text."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every maximal run of the table's bytes; none spans two texts."""
    n = len(data)
    inside = table[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    first = inside & edge[:-1]
    first[1:] |= inside[1:] & ~inside[:-1]
    last = inside & edge[1:]
    last[:-1] |= inside[:-1] & ~inside[1:]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return s, e, np.searchsorted(offsets, s, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK + 1), base, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 8 * CHUNK:
            _POWERS[base] = have
    return have[:n]


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes; equal words hash alike wherever they stand."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=total[1:])
    return mix((total[e] - total[s]) * _powers(_INVERSE, len(data) + 1)[s])


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words' hashes."""
    out = np.zeros(max(0, len(h) - k + 1), dtype=np.uint64)
    for j in range(k):
        out = out * np.uint64(0xD1342543DE82EF95) + h[j : len(h) - k + 1 + j]
    return mix(out)


def long_lists(parts: list[np.ndarray], kind: pa.DataType | None = None) -> pa.Array:
    """A list array of the parts."""
    ends = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64) if flat.dtype == np.uint64 else flat, type=kind))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def filtered(docs: DataFrame, work: Callable[[DataFrame], DataFrame], results: list[str]) -> DataFrame:
    """``work(docs)``, a filter by result columns, with the columns of ``docs`` alone; a column that has a
    result's name is kept as it was."""
    own = {c: f"_own_{c}" for c in docs.columns if c in results}
    done = work(docs.withColumnsRenamed(own))
    return done.select(*[F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns])
