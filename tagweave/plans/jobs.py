"""The four jobs. Each is a short composition; Spark plans the data work.

Order of a day: every enabled tag's job, then merge, export and bitmap,
each reading what the previous one wrote. Every job overwrites exactly its
own output for the date, so any of them can be rerun after a failure.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.codes import BITMAP_TABLES, check_date
from tagweave.operators.bitmap import (
    DENSE_MIN_IDS_PER_GROUP,
    SPARSE_MAX,
    bitmap_schema,
    bitmap_slice,
    dense_from_bitmaps,
    dense_tags,
    route_by_type,
    uid_to_long,
    unpivot_tags,
)
from tagweave.operators.export import cluster_by_uid, partitions_for
from tagweave.operators.tags import build_tag
from tagweave.operators.wide import build_wide
from tagweave.session import bounded_session
from tagweave.sources.catalog import Catalog
from tagweave.sources.jdbc import write_jdbc
from tagweave.sources.store import ProfileStore

log = logging.getLogger("tagweave")

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
#: Shuffled cells take about 13 bytes each and a hundred when they are sorted.
MERGE_PARTITIONS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20}
#: At most about this many rows of tags to a shuffle partition, before small ones are put together.
MERGE_CELLS = 1_000_000


def run_tag_job(
    spark: SparkSession, catalog: Catalog, store: ProfileStore, task_id: int, execute_date: str
) -> str:
    """Compute one tag for a date and overwrite its ``dt`` slice."""
    check_date(execute_date)
    tag = catalog.tag_for_task(task_id)
    rows = build_tag(spark, catalog, task_id, execute_date)
    store.write_tag(rows, tag["tag_code"], execute_date)
    log.info("tag %s (task %s) written for %s", tag["tag_code"], task_id, execute_date)
    return store.tag_path(tag["tag_code"])


def enabled_task_ids(catalog: Catalog) -> list[int]:
    """Tasks that are enabled and compute a tag, in id order."""
    return catalog.enabled_task_ids()


def _concurrently(fn, items, parallelism: int) -> list:
    """Submit independent Spark jobs from a few driver threads.

    With the session's FAIR scheduling their tasks share the executors, so short jobs do not wait behind
    each other's fixed costs (planning, listing, commit). Results keep the
    order of ``items``; the first failure is raised.
    """
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [fn(i) for i in items]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as pool:
        return list(pool.map(fn, items))


def merge_frame(
    catalog: Catalog, store: ProfileStore, execute_date: str, missing_ok: bool = False, clustered: bool = False
) -> DataFrame:
    return build_wide(store, catalog.enabled_tag_rows(), execute_date, missing_ok, clustered)


def run_merge_job(
    spark: SparkSession,
    catalog: Catalog,
    store: ProfileStore,
    execute_date: str,
    missing_ok: bool = False,
) -> str:
    """Union + pivot the enabled tags of a date; overwrite the dated wide table, each file a sorted range of uid.

    It runs in a session of its own, whose shuffle partitions are many enough and small enough that
    what a task sorts does not grow with the tags and uids.
    """
    own = bounded_session(spark, MERGE_PARTITIONS)
    codes = [t["tag_code"] for t in catalog.enabled_tag_rows()]
    least = store.count_tag_rows(codes, execute_date) // MERGE_CELLS + 1
    own.conf.set(SHUFFLE_PARTITIONS, str(max(least, int(own.conf.get(SHUFFLE_PARTITIONS)))))
    wide = merge_frame(catalog, store.in_session(own), execute_date, missing_ok, clustered=True)
    return store.write_wide(wide, execute_date, sorted_by="uid")


def run_export_job(
    spark: SparkSession,
    catalog: Catalog,
    store: ProfileStore,
    execute_date: str,
    jdbc: dict | None = None,
    num_partitions: int | None = None,
) -> str:
    """Copy the wide table to its export form.

    With ``jdbc`` options (``url``, ``driver``, ...) the rows go to a JDBC
    table named like the wide table; otherwise to a uid-clustered Parquet
    dataset. The merge job's table is clustered already: it is copied file by
    file, without a shuffle or sort. One stored by other means, or a
    given ``num_partitions``, is clustered here (by default about 256 MB per
    file, sized from the wide table on disk). Both targets replace the previous export of the date.
    ``num_partitions`` is the number of writers on either way (JDBC: 4 by default).
    """
    wide = store.read_wide(execute_date)
    if jdbc is not None:
        opts = dict(jdbc)
        opts.setdefault("table", store.wide_path(execute_date).rsplit("/", 1)[-1])
        if num_partitions is not None:
            opts["num_partitions"] = num_partitions
        write_jdbc(wide, mode=opts.pop("mode", "overwrite"), **opts)
        return opts["table"]
    path, wide_path = store.export_path(execute_date), store.wide_path(execute_date)
    merged = store.published(wide_path)
    if num_partitions is None and merged.sorted_by == "uid":
        rows = store.read_files_apart(wide_path)
    else:
        rows = cluster_by_uid(wide, num_partitions or partitions_for(store.size_bytes(wide_path)))
    return store.replace(rows, path, source=merged.version, sorted_by="uid")


@dataclass(frozen=True)
class BitmapOptions:
    layout: str = "auto"
    on_bad_uid: str = "error"
    sparse_max: int = SPARSE_MAX
    dense_min_ids_per_group: int = DENSE_MIN_IDS_PER_GROUP
    first_run_scan: bool = False
    parallelism: int = 4


def bitmap_input(store: ProfileStore, execute_date: str) -> DataFrame:
    """The date's uid-clustered export if it is current, else the wide table.

    The export is current if it names the wide table's version as its source
    (a rerun merge without a Parquet export must not be shadowed by an old one).
    """
    wide = store.published(store.wide_path(execute_date))
    export = store.published(store.export_path(execute_date))
    if wide and export and export.source == wide.version:
        return store.read_export(execute_date)
    return store.read_wide(execute_date)


def routing(
    store: ProfileStore,
    wide: DataFrame,
    routed: dict,
    execute_date: str,
    min_ids_per_group: int,
    first_run_scan: bool = False,
) -> list[str]:
    """Tags to build with map-side partial bitmaps (``auto`` layout).

    Taken from the latest earlier date's bitmap slices when there are any
    (compact rows, no scan of today's input). Routing changes cost only,
    never results, so statistics from an earlier day are safe to use. With
    no earlier date every tag goes to ``hybrid`` (bounded cost for any value
    distribution), or, with ``first_run_scan``, one statistics job over
    today's input decides.
    """
    previous = []
    for code, table in BITMAP_TABLES.items():
        path = store.table_path(table)
        earlier = [d for d in store.slice_dates(path) if d < execute_date]
        if routed[code] and earlier:
            previous.append(read_bitmaps(store, code, earlier[-1]).withColumn(
                "tag_value", F.col("tag_value").cast("string")))
    if previous:
        rows = reduce(DataFrame.unionByName, previous)
        return dense_from_bitmaps(rows, min_ids_per_group)
    if not first_run_scan:
        return []
    columns = [t["tag_code"].lower() for tags in routed.values() for t in tags]
    return dense_tags(unpivot_tags(wide, columns), min_ids_per_group)


def run_bitmap_job(
    spark: SparkSession,
    catalog: Catalog,
    store: ProfileStore,
    execute_date: str,
    options: BitmapOptions = BitmapOptions(),
) -> dict[str, str]:
    """Rewrite the date's slice of all four typed bitmap tables.

    A type without enabled tags still has its slice cleared. Each type's job
    reads only uid and that type's columns. The input is the uid-clustered
    export when there is one (map-side partial bitmaps then cover whole uid
    runs), else the wide table.
    """
    check_date(execute_date)
    routed = route_by_type(catalog.enabled_tag_rows())
    wide, dense = None, None
    if any(routed.values()):
        wide = bitmap_input(store, execute_date)
        if options.on_bad_uid == "drop":
            bad = wide.count() - uid_to_long(wide.select("uid"), "drop").count()
            if bad:
                log.warning("bitmaps of %s: %d wide rows left out for a bad uid", execute_date, bad)
        if options.layout == "auto":
            dense = routing(
                store,
                wide,
                routed,
                execute_date,
                options.dense_min_ids_per_group,
                options.first_run_scan,
            )

    def write_type(type_code: str) -> str:
        tags = routed[type_code]
        if tags:
            rows = bitmap_slice(
                wide,
                tags,
                type_code,
                layout=options.layout,
                on_bad_uid=options.on_bad_uid,
                sparse_max=options.sparse_max,
                dense_min_ids_per_group=options.dense_min_ids_per_group,
                dense=dense,
            )
        else:
            rows = spark.createDataFrame([], bitmap_schema(type_code))
        path = store.table_path(BITMAP_TABLES[type_code])
        store.overwrite_slice(rows, path, execute_date)
        return path

    codes = list(BITMAP_TABLES)
    return dict(zip(codes, _concurrently(write_type, codes, options.parallelism)))


def register_tables(catalog: Catalog, store: ProfileStore, execute_date: str | None = None) -> list[str]:
    """Expose the enabled tags' tables, the bitmap tables and (for a date)
    the wide table in the session catalog under the store's database name."""
    names = [store.register_tag(t["tag_code"], t["tag_value_type"]) for t in catalog.enabled_tag_rows()]
    for code, table in BITMAP_TABLES.items():
        if store.exists(store.table_path(table)):
            names.append(store.register_dated(table, bitmap_schema(code)))
    if execute_date is not None and store.published(store.wide_path(execute_date)):
        names.append(store.register_wide(execute_date))
    return names


def read_bitmaps(
    store: ProfileStore, type_code: str, execute_date: str | None = None, require_slice: bool = True
) -> DataFrame:
    """The states of one date, or of all dates with their ``dt``.

    A date whose bitmaps were never built raises; with ``require_slice=False`` it has no rows.
    """
    rows = store.read_slices(
        store.table_path(BITMAP_TABLES[type_code]), bitmap_schema(type_code), execute_date, require_slice
    )
    return rows if execute_date is None else rows.drop("dt")


def run_tag_jobs(
    spark: SparkSession,
    catalog: Catalog,
    store: ProfileStore,
    execute_date: str,
    parallelism: int = 16,
) -> list[str]:
    """Every enabled task's tag job for a date (independent, run concurrently).

    ``parallelism`` bounds the driver threads submitting jobs; the cluster's
    scheduler shares the executors among the running jobs.
    """
    task_ids = enabled_task_ids(catalog)
    catalog.prefetch(task_ids)
    return _concurrently(
        lambda task_id: run_tag_job(spark, catalog, store, task_id, execute_date),
        task_ids,
        parallelism,
    )


def run_day(
    spark: SparkSession,
    catalog: Catalog,
    store: ProfileStore,
    execute_date: str,
    bitmap_options: BitmapOptions = BitmapOptions(),
    jdbc: dict | None = None,
    export_partitions: int | None = None,
) -> None:
    """All enabled tags, then merge, export and bitmaps for one date.

    The catalog is validated first, so a bad entry stops the day before any
    table is written.
    """
    check_date(execute_date)
    catalog.validate()
    log.info("day %s: %d enabled tags", execute_date, len(catalog.enabled_tag_rows()))
    run_tag_jobs(spark, catalog, store, execute_date)
    run_merge_job(spark, catalog, store, execute_date)
    run_export_job(spark, catalog, store, execute_date, jdbc=jdbc, num_partitions=export_partitions)
    run_bitmap_job(spark, catalog, store, execute_date, bitmap_options)
