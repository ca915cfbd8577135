"""Profile store: date-partitioned tag tables, dated wide tables, bitmap tables.

Every table is a folder of Parquet datasets under one root on shared storage: a
dated slice is ``<table>/dt=<yyyy-MM-dd>``, a wide table or export one
folder. Each is published as a whole through its manifest (see
:mod:`tagweave.sources.manifest`), so a rerun leaves the same table, other dates
are kept, a run with no rows leaves the slice empty, and a run that fails at any
point leaves the previous version; a slice counts as computed only once it is
published. Readers give an explicit schema (``dt`` stays text), list only the
slices they need, and know from the manifest which type a slice was stored with. On a
cluster the store's folder must be named (``root`` or ``spark.tagweave.store.dir``):
permanent tables do not go below the checkpoint folder, which is cleaned.
"""

from __future__ import annotations

import copy
import json
import os
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.codes import check_date, value_type, wide_table_name
from tagweave.session import bounded_session, shared_root
from tagweave.sources import manifest
from tagweave.sources.catalog import local_frame
from tagweave.sources.manifest import ConcurrentWriteError, Manifest

__all__ = ["ConcurrentWriteError", "MissingTableError", "ProfileStore", "tag_schema", "with_dt"]


class MissingTableError(FileNotFoundError):
    """A table (or tag, or slice) the job reads has never been written."""


_PLACES = T.StructType([T.StructField("_folder", T.StringType()), T.StructField("tag", T.IntegerType())])
#: Manifests are read by this many driver threads.
READERS = 16
#: A tag's rows are a few bytes each in a file and a hundred in memory: many tags are read in small splits.
TAG_SPLITS = {"spark.sql.files.maxPartitionBytes": 8 << 20, "spark.sql.files.openCostInBytes": 1 << 20}
#: More bytes than any file has.
NEVER_PACKED = 1 << 50


def _as_stored(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a slice in the table's types; a value that does not fit raises, whatever the ANSI setting.

    The stored types differ from the table's only where a tag's type was changed later.
    """

    def column(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if frame.schema[field.name].dataType == field.dataType:
            return value
        parsed = value.try_cast(field.dataType)
        message = F.concat(F.lit("stored value "), value.cast("string"), F.lit(f" is not {field.dataType.simpleString()}"))
        return F.when(value.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed).cast(field.dataType).alias(field.name)

    return frame.select([column(f) for f in schema.fields])


def tag_schema(type_code: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField("uid", T.StringType()),
            T.StructField("query_value", value_type(type_code)),
        ]
    )


def with_dt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("dt", T.StringType())])


class ProfileStore:
    """Paths and read/write of the profile database below ``root``."""

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        database: str = "user_profile",
        compression: str = "zstd",
    ):
        """``compression``: Parquet codec of every output. zstd shrinks the
        mostly-zero 4 KB bitmaps about tenfold against snappy."""
        self.spark = spark
        self.compression = compression
        base = root or spark.conf.get("spark.tagweave.store.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise RuntimeError("name the store's folder: ProfileStore(root=...) or spark.tagweave.store.dir")
            base = os.path.join(shared_root(spark), "tagweave")
        self.root = os.path.join(base, database)
        self.database = database

    # -- names --------------------------------------------------------------
    def table_path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def tag_path(self, tag_code: str) -> str:
        return self.table_path(tag_code.lower())

    def wide_path(self, execute_date: str) -> str:
        return self.table_path(wide_table_name(execute_date))

    def export_path(self, execute_date: str) -> str:
        return os.path.join(self.root, "export", wide_table_name(execute_date))

    def published(self, path: str) -> Manifest | None:
        """The current version of the dataset at ``path``, or None if none was ever published."""
        return manifest.read_manifest(self.spark, path)

    def exists(self, path: str) -> bool:
        """Whether there is such a folder: a table, whatever its slices."""
        return manifest.exists(self.spark, path)

    def size_bytes(self, path: str) -> int:
        """Bytes of the dataset's current version (one metadata call, no data read)."""
        fs, hpath = manifest.filesystem(self.spark, self._data(path))
        return int(fs.getContentSummary(hpath).getLength())

    def _data(self, path: str) -> str:
        found = self.published(path)
        if found is None:
            raise MissingTableError(f"{path} has never been computed")
        return f"{path}/{found.folder}"

    # -- datasets -----------------------------------------------------------
    def replace(self, df: DataFrame, target: str, source: str | None = None, sorted_by: str = "") -> str:
        """Publish ``df`` at ``target``; ``source``: the version of the data it was made from.

        ``sorted_by``: the column of which ``df``'s partitions are sorted ranges, if they are.
        """
        manifest.publish(df, target, source, self.compression, self._before_publishing, sorted_by)
        return target

    def _before_publishing(self, target: str) -> None:
        """Runs when the data are written and not yet published (tests put another writer or a failure here)."""

    def read_dataset(self, path: str) -> DataFrame:
        """The current version of the dataset at ``path``."""
        found = self.published(path)
        if found is None:
            raise MissingTableError(f"{path} has never been computed")
        return self.spark.read.schema(found.columns).parquet(f"{path}/{found.folder}")

    def read_files_apart(self, path: str) -> DataFrame:
        """The current version of the dataset at ``path``, one partition a file, in the file's order.

        The frame belongs to a session of its own: Spark packs and splits files by session settings.
        """
        found = self.published(path)
        if found is None:
            raise MissingTableError(f"{path} has never been computed")
        apart = self.spark.newSession()
        for name in ("maxPartitionBytes", "openCostInBytes"):
            apart.conf.set(f"spark.sql.files.{name}", str(NEVER_PACKED))
        apart.conf.unset("spark.sql.files.maxPartitionNum")
        return apart.read.schema(found.columns).parquet(f"{path}/{found.folder}")

    # -- dated slices -------------------------------------------------------
    def overwrite_slice(self, df: DataFrame, path: str, execute_date: str) -> None:
        """Replace ``<path>/dt=D`` with ``df`` (static-partition overwrite).

        The whole slice is replaced, so it is cleared even when ``df``
        has no rows (a dynamic overwrite would leave the old files then).
        """
        check_date(execute_date)
        out = df.drop("dt") if "dt" in df.columns else df
        self.replace(out, f"{path}/dt={execute_date}")

    def slices(self, path: str, dates: Sequence[str] | None = None) -> dict[str, Manifest]:
        """The published slices of a dated table by date (one listing call and a small read for each)."""
        if dates is None:
            if not self.exists(path):
                return {}
            fs, hpath = manifest.filesystem(self.spark, path)
            names = [s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()]
            dates = sorted(n[3:] for n in names if n.startswith("dt="))
        return dict(self._manifests({d: f"{path}/dt={d}" for d in dates}))

    def _manifests(self, datasets: dict) -> list[tuple]:
        """(key, manifest) of the published ones among ``datasets``, a few at a time."""
        with ThreadPoolExecutor(max_workers=READERS) as pool:
            found = list(zip(datasets, pool.map(self.published, datasets.values()), strict=True))
        return [(k, m) for k, m in found if m is not None]

    def slice_dates(self, path: str) -> list[str]:
        """Dates whose slice is published."""
        return list(self.slices(path))

    def _scan(self, base: str, folders: Sequence[str], stored: T.StructType) -> DataFrame:
        return self.spark.read.schema(with_dt(stored)).option("basePath", base).parquet(*folders)

    def read_slices(
        self, path: str, schema: T.StructType, execute_date: str | None = None, require_slice: bool = True
    ) -> DataFrame:
        """All slices (or one) of a dated table, with ``dt`` as text.

        Only the folders of published versions are listed (``basePath`` keeps
        ``dt`` as a column), so for one date the cost does not grow with the
        table's history; slices stored with the same types share a scan. A
        date that was never published raises, or reads as empty with ``require_slice=False``.
        """
        if not self.exists(path):
            raise MissingTableError(path)
        full = with_dt(schema)
        found = self.slices(path, None if execute_date is None else [check_date(execute_date)])
        if execute_date is not None and not found and require_slice:
            raise MissingTableError(f"{path} has never been computed for {execute_date}")
        by_type: dict[str, list[str]] = {}
        for date, m in found.items():
            by_type.setdefault(m.schema, []).append(f"{path}/dt={date}/{m.folder}")
        if not by_type:
            return self.spark.createDataFrame([], full)
        parts = [
            _as_stored(self._scan(path, folders, T.StructType.fromJson(json.loads(stored))), full)
            for stored, folders in by_type.items()
        ]
        return reduce(DataFrame.unionByName, parts)

    # -- tag tables -----------------------------------------------------------
    def write_tag(self, df: DataFrame, tag_code: str, execute_date: str) -> None:
        self.overwrite_slice(df, self.tag_path(tag_code), execute_date)

    def read_tag(
        self, tag_code: str, type_code: str, execute_date: str | None = None, require_slice: bool = True
    ) -> DataFrame:
        path = self.tag_path(tag_code)
        if not self.exists(path):
            raise MissingTableError(f"tag {tag_code} has no table at {path}")
        return self.read_slices(path, tag_schema(type_code), execute_date, require_slice)

    def read_tags(self, tag_codes: Sequence[str], execute_date: str, missing_ok: bool = False) -> DataFrame:
        """``uid, query_value`` (as text) and ``tag``, the position in ``tag_codes``, of many tags' slices of a date.

        One scan for all tags stored with the same types, so the plan does not
        grow with the tags. The text of a value comes from the type it was stored
        with. The tag is found by the folder its rows were read from.
        """
        paths, found = self._tags(tag_codes, execute_date)
        absent = [tag_codes[i] for i in paths if i not in found]
        if absent and not missing_ok:
            raise MissingTableError(f"never computed for {execute_date}: {', '.join(absent)}")
        by_type: dict[str, list[int]] = {}
        for i, m in found.items():
            by_type.setdefault(m.schema, []).append(i)
        parts, split = [], bounded_session(self.spark, TAG_SPLITS)
        for stored, tags in by_type.items():
            columns = T.StructType.fromJson(json.loads(stored))
            rows = split.read.schema(columns).parquet(*[f"{paths[i]}/{found[i].folder}" for i in tags])
            version = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
            text = [F.col(c).cast("string").alias(c) for c in ("uid", "query_value")]
            parts.append(rows.select(*text, version.alias("_folder")))
        if not parts:
            return self.spark.createDataFrame([], "uid string, query_value string, tag int")
        # A row a tag; versions are unique over all tags and need no escaping in a file's address.
        places = local_frame(self.spark, [(m.folder, i) for i, m in found.items()], _PLACES)
        rows = reduce(DataFrame.unionByName, parts)
        return F.broadcast(places).join(rows, "_folder").select("uid", "query_value", "tag")  # a frame of the store's session

    def _tags(self, tag_codes: Sequence[str], execute_date: str) -> tuple[dict[int, str], dict[int, Manifest]]:
        """By position in ``tag_codes``: the folders of the date's slices, and the manifests of those published."""
        check_date(execute_date)
        paths = {i: f"{self.tag_path(code)}/dt={execute_date}" for i, code in enumerate(tag_codes)}
        return paths, dict(self._manifests(paths))

    def count_tag_rows(self, tag_codes: Sequence[str], execute_date: str) -> int:
        """Rows of the tags' slices of a date, from their manifests."""
        return sum(m.rows for m in self._tags(tag_codes, execute_date)[1].values())

    def in_session(self, spark: SparkSession) -> ProfileStore:
        """The same store, its frames belonging to ``spark``."""
        other = copy.copy(self)
        other.spark = spark
        return other

    # -- wide table -------------------------------------------------------------
    def write_wide(self, df: DataFrame, execute_date: str, sorted_by: str = "") -> str:
        """Full overwrite of the dated wide table."""
        return self.replace(df, self.wide_path(execute_date), sorted_by=sorted_by)

    def read_wide(self, execute_date: str) -> DataFrame:
        return self.read_dataset(self.wide_path(execute_date))

    def read_export(self, execute_date: str) -> DataFrame:
        return self.read_dataset(self.export_path(execute_date))

    def vacuum(self, min_age_hours: float = 24.0) -> list[str]:
        """Drop versions that no manifest names, left by runs that died, below the whole store."""
        fs, hpath = manifest.filesystem(self.spark, self.root)
        datasets = [s.getPath().toString() for pattern in ("*", "*/dt=*", "export/*")
                    for s in fs.globStatus(manifest.filesystem(self.spark, f"{self.root}/{pattern}")[1]) or []]
        return [f"{d}/{name}" for d in datasets for name in manifest.vacuum(self.spark, d, min_age_hours)]

    # -- catalog registration ---------------------------------------------------
    def _create_database(self) -> None:
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.root}'"
        )

    def register_dated(self, name: str, schema: T.StructType) -> str:
        """Expose a dated table as ``<database>.<name>`` (partitioned by dt).

        The table is created anew, so it has today's types, and every published
        slice stored with these types is a partition at its current version; queries
        such as ``select * from user_profile.tag_x where dt = '2024-01-15'``
        prune through the catalog. Slices stored with other types (before a tag's type
        was changed) are left out; :meth:`read_slices` reads them. Call again after slices are written.
        """
        self._create_database()
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in with_dt(schema).fields)
        table = f"`{self.database}`.`{name}`"
        path = self.table_path(name)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # an external table: the data stay
        self.spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet PARTITIONED BY (dt) LOCATION '{path}'")
        types = [(f.name, f.dataType) for f in schema.fields]
        places = [
            f"PARTITION (dt = '{date}') LOCATION '{path}/dt={date}/{m.folder}'"
            for date, m in self.slices(path).items()
            if [(f.name, f.dataType) for f in m.columns.fields] == types
        ]
        if places:
            self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(places)}")
        return f"{self.database}.{name}"

    def register_tag(self, tag_code: str, type_code: str) -> str:
        return self.register_dated(tag_code.lower(), tag_schema(type_code))

    def register_wide(self, execute_date: str) -> str:
        """Expose the dated wide table as ``<database>.user_tag_merge_<yyyyMMdd>``."""
        self._create_database()
        name = wide_table_name(execute_date)
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.database}`.`{name}`")
        self.spark.sql(
            f"CREATE TABLE `{self.database}`.`{name}` USING parquet "
            f"LOCATION '{self._data(self.wide_path(execute_date))}'"
        )
        return f"{self.database}.{name}"
