"""Command line: the four jobs with the arguments ``task_id execute_date``.

    spark-submit --py-files tagweave.zip -m tagweave tag    3 2024-01-15 \\
        --catalog parquet:/meta --hive --warehouse-db dw
    python -m tagweave merge  0 2024-01-15 --catalog jdbc:mysql://h/meta ...
    python -m tagweave export 0 2024-01-15 [--jdbc-url ... --jdbc-driver ...]
    python -m tagweave bitmap 0 2024-01-15
    python -m tagweave day    0 2024-01-15      # all of the above

As in the original jobs, only ``tag`` uses the task id; the others take it
and ignore it. On a cluster the store's folder is named by ``--store-root`` or
``spark.tagweave.store.dir``. Without ``--hive`` the catalog lives in the process:
``--warehouse-db`` then finds only what the cluster's own settings provide, and
``--register`` lasts as long as the job.
"""

from __future__ import annotations

import argparse
import sys

from tagweave.plans import jobs
from tagweave.session import get_session
from tagweave.sources.catalog import Catalog
from tagweave.sources.store import ProfileStore
from tagweave.sources.warehouse import register_parquet_views, use_database


def _catalog(spark, spec: str, user: str | None, password: str | None) -> Catalog:
    kind, _, where = spec.partition(":")
    if kind == "parquet":
        return Catalog.from_parquet(spark, where)
    if kind == "jdbc":
        props = {k: v for k, v in (("user", user), ("password", password)) if v}
        return Catalog.from_jdbc(spark, spec, props)
    raise SystemExit(f"--catalog must be parquet:<dir> or jdbc:<url>, got {spec!r}")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tagweave")
    p.add_argument("job", choices=["tag", "merge", "export", "bitmap", "day"])
    p.add_argument("task_id", type=int)
    p.add_argument("execute_date")
    p.add_argument("--catalog", required=True, help="parquet:<dir> or jdbc:<url>")
    p.add_argument("--catalog-user")
    p.add_argument("--catalog-password")
    p.add_argument("--warehouse-db", help="database holding the warehouse tables")
    p.add_argument("--warehouse-parquet", help="folder of <table>.parquet files instead")
    p.add_argument("--store-root", help="shared folder of the profile database")
    p.add_argument("--database", default="user_profile")
    p.add_argument("--bitmap-layout", default="auto", choices=["auto", "hybrid", "bitmap"])
    p.add_argument("--bitmap-sparse-max", type=int, default=512, help="largest group kept as an id list")
    p.add_argument("--bitmap-first-run-scan", action="store_true",
                   help="auto layout: decide a first date from a statistics scan")
    p.add_argument("--drop-bad-uids", action="store_true")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-driver")
    p.add_argument("--jdbc-create-options", help='e.g. "ENGINE = MergeTree() ORDER BY uid"')
    p.add_argument("--export-partitions", type=int, help="writers of the export, to files or JDBC")
    p.add_argument("--hive", action="store_true", help="use the cluster's Hive catalog")
    p.add_argument("--register", action="store_true", help="register tables in the catalog")
    a = p.parse_args(argv)

    spark = get_session(app_name=f"tagweave_{a.job}", hive=a.hive)
    if a.warehouse_parquet:
        register_parquet_views(spark, a.warehouse_parquet)
    elif a.warehouse_db:
        use_database(spark, a.warehouse_db)
    catalog = _catalog(spark, a.catalog, a.catalog_user, a.catalog_password)
    store = ProfileStore(spark, root=a.store_root, database=a.database)
    jdbc = None
    if a.jdbc_url:
        jdbc = {"url": a.jdbc_url, "driver": a.jdbc_driver,
                "create_table_options": a.jdbc_create_options}
    options = jobs.BitmapOptions(
        layout=a.bitmap_layout,
        on_bad_uid="drop" if a.drop_bad_uids else "error",
        sparse_max=a.bitmap_sparse_max,
        first_run_scan=a.bitmap_first_run_scan,
    )
    if a.job == "tag":
        jobs.run_tag_job(spark, catalog, store, a.task_id, a.execute_date)
    elif a.job == "merge":
        jobs.run_merge_job(spark, catalog, store, a.execute_date)
    elif a.job == "export":
        jobs.run_export_job(spark, catalog, store, a.execute_date, jdbc=jdbc, num_partitions=a.export_partitions)
    elif a.job == "bitmap":
        jobs.run_bitmap_job(spark, catalog, store, a.execute_date, options)
    else:
        jobs.run_day(spark, catalog, store, a.execute_date, options, jdbc=jdbc, export_partitions=a.export_partitions)
    if a.register:
        jobs.register_tables(catalog, store, a.execute_date)
    return 0


if __name__ == "__main__":
    sys.exit(main())
