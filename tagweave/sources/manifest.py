"""Published datasets: a folder of data versions and one small manifest naming the current one.

A dataset's folder holds ``v-<version>/`` folders, each written once by Spark's
commit protocol, and ``_manifest``, written last and replaced in one step. Readers resolve
the manifest, so a dataset exists only once it is published, a run that fails
or dies anywhere before that step leaves the published version readable, and
nothing has to be put right by hand: what it wrote is a folder no manifest names.
That holds on object stores too, where no folder is renamed.

The replaced version stays until the next one replaces its successor, for
readers that are under way. :func:`vacuum` drops folders that runs left behind.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("tagweave")

MANIFEST = "_manifest"
#: Schemes whose stores replace a single object in one step but copy on rename.
OBJECT_STORES = ("s3", "s3a", "s3n", "gs", "abfs", "abfss", "wasb", "wasbs", "oss", "cosn")


class ConcurrentWriteError(OSError):
    """Another writer replaced the same data; this run's rows were not stored."""


@dataclass(frozen=True)
class Manifest:
    """What a dataset's current version is."""

    version: str
    folder: str  # name of the version's folder, below the dataset's
    schema: str  # JSON of the stored columns
    rows: int
    source: str = ""  # version of the data it was made from
    previous: str = ""  # folder it replaced
    sorted_by: str = ""  # column whose ranges the files hold, each file sorted by it

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = filesystem(spark, path)
    return bool(fs.exists(hpath))


def read_manifest(spark: SparkSession, dataset: str) -> Manifest | None:
    """The published version of a dataset, or None."""
    fs, path = filesystem(spark, f"{dataset}/{MANIFEST}")
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(**json.loads(text))


def _replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see the old text or the new one, never a part."""
    fs, final = filesystem(spark, path)
    scheme = str(fs.getUri().getScheme())
    target = path if scheme in OBJECT_STORES else f"{path}.{uuid.uuid4().hex}"
    out = fs.create(filesystem(spark, target)[1], True)
    out.write(bytearray(text.encode()))
    out.close()  # an object store shows the object from here on
    if target == path:
        return
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    rename = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
    options = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = jvm.java.lang.Enum.valueOf(rename, "OVERWRITE")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    qualified = fs.makeQualified(filesystem(spark, target)[1])
    context.rename(qualified, fs.makeQualified(final), options)


def _drop(spark: SparkSession, path: str) -> None:
    fs, hpath = filesystem(spark, path)
    fs.delete(hpath, True)


def publish(
    df: DataFrame,
    dataset: str,
    source: str | None = None,
    compression: str = "zstd",
    before_publishing: Callable[[str], None] = lambda dataset: None,
    sorted_by: str = "",
) -> Manifest:
    """Write ``df`` as the dataset's new version and make it the current one.

    If another writer published in between, its version stays and this one
    raises :class:`ConcurrentWriteError`. Rows are counted while they are written.
    ``sorted_by`` states that ``df``'s partitions are sorted ranges of that column.
    """
    spark = df.sparkSession
    dataset = dataset.rstrip("/")
    before = read_manifest(spark, dataset)
    version = uuid.uuid4().hex
    folder = f"v-{version}"
    try:
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("errorifexists").option("compression", compression).parquet(f"{dataset}/{folder}")
        new = Manifest(
            version, folder, df.schema.json(), int(seen.get["rows"]), source or "", before.folder if before else "", sorted_by
        )
        before_publishing(dataset)
        if read_manifest(spark, dataset) != before:
            raise ConcurrentWriteError(f"{dataset}: another writer replaced it meanwhile")
        _replace_file(spark, f"{dataset}/{MANIFEST}", json.dumps(asdict(new)))
    except BaseException:
        _drop(spark, f"{dataset}/{folder}")
        raise
    if before and before.previous:
        try:
            _drop(spark, f"{dataset}/{before.previous}")
        except Exception:  # published already; vacuum gets it
            log.warning("%s: could not drop %s", dataset, before.previous)
    return new


def vacuum(spark: SparkSession, dataset: str, min_age_hours: float = 24.0) -> list[str]:
    """Drop what is in a dataset's folder and neither current nor just replaced, if old enough for no writer to be at it."""
    fs, hpath = filesystem(spark, dataset)
    if not fs.exists(hpath):
        return []
    current = read_manifest(spark, dataset)
    kept = {MANIFEST, f".{MANIFEST}.crc"} | ({current.folder, current.previous} if current else set())
    dropped = []
    for status in fs.listStatus(hpath):
        name = status.getPath().getName()
        age = time.time() - status.getModificationTime() / 1000
        if name not in kept and (name.startswith("v-") or name.startswith(MANIFEST)) and age >= min_age_hours * 3600:
            fs.delete(status.getPath(), True)
            dropped.append(name)
    return sorted(dropped)
