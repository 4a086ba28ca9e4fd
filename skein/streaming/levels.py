"""Incremental compaction of an upsert output: runs in levels, named by a manifest.

The changelog of :mod:`skein.streaming.sinks` is one folder per version.  A
compaction writes the latest rows of the *new* versions as a run of level 0;
where that is the ``FANOUT``-th of its level, all of them as one of the next.  So a row is rewritten
once a level, and the bytes of a compaction follow the new versions, not all
that has been compacted before.  A generation of the manifest is the full list
of the runs that count; readers take the newest, and the versions after its
last one.  What a generation no longer needs is deleted only when ``grace``
newer ones are there, so a reader that has planned its files keeps them.

A failed compaction leaves files that no generation names; two at a time can't
both write the next generation.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.streaming.sinks import CHANGELOG, compact

FANOUT = 8
MANIFEST = "gen long, run string, level int, upto long"


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its path class (listing and deleting are no DataFrame operations)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def _folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Values of the complete folders ``<prefix>=<value>`` in a path."""
    files, Path = _files(spark, path)
    if not files.exists(Path(path)):
        return []
    found = [f.getPath() for f in files.listStatus(Path(path)) if f.getPath().getName().startswith(f"{prefix}=")]
    return [p.getName().split("=", 1)[1] for p in found if files.exists(Path(p, "_SUCCESS"))]


def _manifest(spark: SparkSession, path: str) -> dict[int, list]:
    """The generations that are there: their runs' rows (a handful for each level)."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{path}_generations/gen=*").collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return {}
        raise
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r.gen, []).append(r)
    return out


def _runs(spark: SparkSession, path: str, runs: list[str]) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], CHANGELOG)
    return spark.read.schema(CHANGELOG).parquet(*[f"{path}_runs/run={r}" for r in runs])


def _versions(spark: SparkSession, path: str, versions: list[int]) -> DataFrame:
    if not versions:
        return spark.createDataFrame([], CHANGELOG)
    return spark.read.schema(CHANGELOG).option("basePath", path).parquet(*[f"{path}/version={v}" for v in versions])


def _covered(generation: list) -> int:
    return max((r.upto for r in generation), default=-1)


def read_levels(spark: SparkSession, path: str) -> DataFrame:
    """Latest row per key: the newest generation's runs and the complete versions after them."""
    manifest = _manifest(spark, path)
    newest = manifest[max(manifest)] if manifest else []
    later = [v for v in map(int, _folders(spark, path, "version")) if v > _covered(newest)]
    rows = _runs(spark, path, [r.run for r in newest]).unionByName(_versions(spark, path, sorted(later)))
    return compact(rows)


def compact_levels(spark: SparkSession, path: str, fanout: int = FANOUT, grace: int = 1) -> str | None:
    """Compact the complete versions that no run holds yet; returns the run written, if any.

    Run it between the stream's batches or beside it: versions that aren't
    complete are left alone.  ``grace``: generations whose files are kept
    besides the newest one's.
    """
    if fanout < 2 or grace < 0:
        raise ValueError("fanout is 2 or more, grace 0 or more")
    manifest = _manifest(spark, path)
    gen = max(manifest, default=-1)
    live = [(r.run, r.level, r.upto) for r in manifest.get(gen, [])]
    covered = max((u for _, _, u in live), default=-1)
    new = sorted(v for v in map(int, _folders(spark, path, "version")) if v > covered)
    if not new:
        return None
    # A level that the new run would fill goes into it, which then is one of the next level.
    level, full = 0, []
    while len(same := [r for r in live if r[1] == level]) + 1 >= fanout:
        full += same
        level += 1
    live = [r for r in live if r not in full]
    run = uuid.uuid4().hex
    compact(_runs(spark, path, [r[0] for r in full]).unionByName(_versions(spark, path, new))).write.parquet(f"{path}_runs/run={run}")
    live.append((run, level, new[-1]))
    gen += 1
    rows = spark.createDataFrame([(gen, *r) for r in live], MANIFEST)
    rows.select("gen", "run", "level", "upto").coalesce(1).write.parquet(f"{path}_generations/gen={gen}")
    _retire(spark, path, {**{g: [(r.run, r.level, r.upto) for r in rs] for g, rs in manifest.items()}, gen: live}, gen - grace)
    return run


def _retire(spark: SparkSession, path: str, manifest: dict[int, list], oldest: int) -> None:
    """Delete the generations before ``oldest``, and the runs and versions that no later one's readers need."""
    kept = {g: runs for g, runs in manifest.items() if g >= oldest}
    needed = {r[0] for runs in kept.values() for r in runs}
    files, Path = _files(spark, path)
    gone = [f"{path}_generations/gen={g}" for g in manifest if g < oldest]
    gone += [f"{path}_runs/run={r[0]}" for g, runs in manifest.items() if g < oldest for r in runs if r[0] not in needed]
    # A reader of a generation takes the versions after its last one.
    if len(kept) == len(manifest) and oldest < 0:
        held = -1  # before the first generation, readers took versions alone
    else:
        held = min((max(r[2] for r in runs) for runs in kept.values()), default=-1)
    gone += [f"{path}/version={v}" for v in map(int, _folders(spark, path, "version")) if v <= held]
    for folder in gone:
        files.delete(Path(folder), True)
