"""Which files of a partitioned folder count: a list that changes in one step.

Every landing writes its rows under a name of its own (``.../month=1/run=<id>``), where no reader looks,
and then commits a new manifest that names the runs of each partition. A landing that dies before
the commit has changed nothing; readers see all of it or none. Manifests are numbered, and a number can
be taken once: of two writers that started from the same manifest, the later one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.operators.quality import observed_rows

FOLDER = "_manifests"  # Spark's readers pass over names that begin so
KEPT_MANIFESTS = 5
RUN = "run"


@dataclass(frozen=True)
class Manifest:
    """``runs`` by partition (``year=2019/month=1``); ``batches``: the last one each stream landed."""

    number: int = 0
    partitions: tuple[str, ...] = ()
    schema: str | None = None
    runs: dict[str, list[str]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)

    def paths(self, dest: str) -> list[str]:
        return [
            f"{dest}/{partition}/{RUN}={run}"
            for partition, runs in sorted(self.runs.items()) for run in runs
        ]


class CommitConflict(Exception):
    """Another writer committed first; nothing has changed, and the landing can be run again."""


def read_manifest(spark: SparkSession, dest: str) -> Manifest:
    numbers = _numbers(spark, dest)
    if not numbers:
        return Manifest()
    location = _path(spark, f"{dest}/{FOLDER}/{numbers[-1]:012d}.json")
    stream = _system(spark, location).open(location)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    found = json.loads(text)
    return Manifest(**found | {"partitions": tuple(found["partitions"])})


def commit_manifest(spark: SparkSession, dest: str, manifest: Manifest) -> None:
    """Make the manifest the next one after the number it has."""
    number = manifest.number + 1
    jvm = spark._jvm
    waiting = _path(spark, f"{dest}/{FOLDER}/.{uuid.uuid4().hex}")
    system = _system(spark, waiting)
    stream = system.create(waiting)
    try:
        stream.write(bytearray(json.dumps(vars(manifest) | {"number": number}).encode()))
    finally:
        stream.close()
    taken = _path(spark, f"{dest}/{FOLDER}/{number:012d}.json")
    option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        taken.toUri() if taken.toUri().getScheme() else system.getUri(),
        spark._jsc.hadoopConfiguration(),
    )
    try:
        # Unlike a rename of the file system's own, this one never takes a name that is in use.
        context.rename(
            system.makeQualified(waiting), system.makeQualified(taken),
            spark.sparkContext._gateway.new_array(option, 0),
        )
    except Exception as error:
        system.delete(waiting, False)
        if system.exists(taken):
            raise CommitConflict(f"{dest}: manifest {number} was committed by another run") from error
        raise
    for old in _numbers(spark, dest)[:-KEPT_MANIFESTS]:
        system.delete(_path(spark, f"{dest}/{FOLDER}/{old:012d}.json"), False)


def land(
    df: DataFrame,
    dest: str,
    partitions: list[str],
    replaced: Iterable[str] | None = None,
    batch: tuple[str, int] | None = None,
) -> int:
    """Write ``df`` by ``partitions`` and commit it; returns the rows written.

    ``replaced`` names the partitions whose earlier rows go, also if ``df`` has none for them;
    without it the rows are added. ``batch`` is a stream's name and its batch: one that has been
    committed before adds nothing. Rows of a partition are gathered into few files, and a partition
    with an outsized share of the rows is split over several tasks.
    """
    spark = df.sparkSession
    before = read_manifest(spark, dest)
    if batch and before.batches.get(batch[0], -1) >= batch[1]:
        return 0
    run = uuid.uuid4().hex
    counted, counter = observed_rows(df.hint("rebalance", *partitions).withColumn(RUN, F.lit(run)))
    counted.write.mode("append").partitionBy(*partitions, RUN).parquet(dest)
    runs = {p: list(r) for p, r in before.runs.items()}
    for partition in replaced or ():
        runs.pop(partition, None)
    for partition in _written(spark, dest, partitions, run):
        runs.setdefault(partition, []).append(run)
    now = replace(
        before, partitions=tuple(partitions), schema=df.schema.json(), runs=runs,
        batches=before.batches | ({batch[0]: batch[1]} if batch else {}),
    )
    commit_manifest(spark, dest, now)
    if replaced:
        # What the manifest before named stays for those who still read it, until the next landing.
        _remove_unnamed(spark, dest, replaced, (before, now))
    return counter.get["rows"]


def read_landed(spark: SparkSession, dest: str) -> DataFrame:
    """The rows of the last committed manifest, from the files that it names only."""
    manifest = read_manifest(spark, dest)
    if manifest.schema is None:
        raise ValueError(f"nothing has landed in {dest}")
    schema = T.StructType.fromJson(json.loads(manifest.schema))
    if not manifest.runs:
        return spark.createDataFrame([], schema)
    # In the order in which the folders lie, partitions last, as a plain scan would give them.
    data = [f for f in schema if f.name not in manifest.partitions]
    by_name = {f.name: f for f in schema}
    stored = T.StructType(
        [*data, *[by_name[p] for p in manifest.partitions], T.StructField(RUN, T.StringType())]
    )
    scan = spark.read.schema(stored).option("basePath", dest).parquet(*manifest.paths(dest))
    return scan.drop(RUN)


def remove_unnamed(spark: SparkSession, dest: str) -> None:
    """Delete what no manifest names any more: replaced rows, and what failed landings left."""
    now = read_manifest(spark, dest)
    root = _path(spark, dest)
    found = _glob(spark, f"{dest}/{'/'.join(f'{p}=*' for p in now.partitions)}")
    base = _system(spark, root).makeQualified(root).toString()
    _remove_unnamed(spark, dest, [f.removeprefix(f"{base}/") for f in found], (now,))


def _remove_unnamed(
    spark: SparkSession, dest: str, partitions: Iterable[str], manifests: tuple[Manifest, ...]
) -> None:
    for partition in partitions:
        named = {run for m in manifests for run in m.runs.get(partition, ())}
        for folder in _glob(spark, f"{dest}/{partition}/{RUN}=*"):
            if folder.rpartition(f"{RUN}=")[2] not in named:
                location = _path(spark, folder)
                _system(spark, location).delete(location, True)


def _written(spark: SparkSession, dest: str, partitions: list[str], run: str) -> list[str]:
    folders = _glob(spark, f"{dest}/{'/'.join(f'{p}=*' for p in partitions)}/{RUN}={run}")
    return ["/".join(f.split("/")[-len(partitions) - 1:-1]) for f in folders]


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    location = _path(spark, pattern)
    found = _system(spark, location).globStatus(location)
    return [status.getPath().toString() for status in found or ()]


def _numbers(spark: SparkSession, dest: str) -> list[int]:
    names = [f.rpartition("/")[2] for f in _glob(spark, f"{dest}/{FOLDER}/*.json")]
    return sorted(int(n.removesuffix(".json")) for n in names)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, location):
    return location.getFileSystem(spark._jsc.hadoopConfiguration())
