"""Benchmark: one full profile day on the sample warehouse.

Runs every enabled tag of the sample catalog, the merge, the uid-clustered
export and the four typed bitmap tables, then the two bitmap readers
(cardinality per (tag, value), decode to uids), and prints one JSON line:
the median of ``BENCH_PASSES`` (3) timed passes after an untimed warm-up
pass on the smallest tables. ``value`` is the sum of the day's job times;
the ``probe4_*`` entries repeat the baseline's own probe workloads (four
tags to a collected wide table; wide table to collected cardinalities).

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tagweave.operators.bitmap import (  # noqa: E402
    build_bitmaps,
    cardinality,
    decode,
    uid_to_long,
    unpivot_tags,
)
from tagweave.operators.tags import build_tag  # noqa: E402
from tagweave.operators.wide import pivot_tags, tag_branch, union_tags  # noqa: E402
from tagweave.plans import jobs  # noqa: E402
from tagweave.plans.contract import MANY_TAGS, _all_bitmaps  # noqa: E402
from tagweave.plans.seed import EXECUTE_DATE, SEED_TABLES, seed_catalog  # noqa: E402
from tagweave.session import get_session, scratch_dir  # noqa: E402
from tagweave.sources.store import ProfileStore  # noqa: E402
from tagweave.sources.warehouse import register_parquet_views  # noqa: E402
from tools.eventlog_summary import shuffle_bytes  # noqa: E402

WARMUP_DIR = "/root/testdata/sf0.001"


def run(spark, sf_dir: str, timings: dict | None) -> None:
    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        if timings is not None:
            timings[name] = round(time.perf_counter() - t, 3)
        return out

    register_parquet_views(spark, sf_dir, SEED_TABLES)
    catalog = seed_catalog(spark)
    store = ProfileStore(spark, root=scratch_dir(spark, "bench"))
    timed("tag_jobs", lambda: jobs.run_tag_jobs(spark, catalog, store, EXECUTE_DATE))
    timed("merge_job", lambda: jobs.run_merge_job(spark, catalog, store, EXECUTE_DATE))
    timed("export_job", lambda: jobs.run_export_job(spark, catalog, store, EXECUTE_DATE))
    timed("bitmap_job", lambda: jobs.run_bitmap_job(spark, catalog, store, EXECUTE_DATE))
    timed("cardinality", lambda: cardinality(_all_bitmaps(store)).collect())
    timed("decode", lambda: decode(_all_bitmaps(store)).count())
    # The two workloads of the baseline probe (4 tags: string, long, decimal,
    # date), kept out of the day total: tags -> union -> pivot, cached and
    # collected; then cached wide -> unpivot -> bitmaps -> cardinality.
    probe_tags = [t for t in catalog.enabled_tag_rows() if t["tag_task_id"] in (1, 2, 3, 4)]
    holder = {}

    def probe_wide():
        branches = [
            tag_branch(build_tag(spark, catalog, t["tag_task_id"], EXECUTE_DATE), t["tag_code"])
            for t in probe_tags
        ]
        wide = pivot_tags(union_tags(branches), [t["tag_code"] for t in probe_tags]).cache()
        holder["wide"] = wide
        return sorted(wide.collect(), key=lambda r: r["uid"])

    def probe_bitmaps():
        columns = [t["tag_code"].lower() for t in probe_tags]
        pairs = uid_to_long(unpivot_tags(holder["wide"], columns))
        return len(cardinality(build_bitmaps(pairs)).collect())

    # Sixty tags, each in a slice of its own: tag jobs untimed, then their merge.
    many = seed_catalog(spark, tags=MANY_TAGS, labels=[], rules=[])
    many_store = ProfileStore(spark, root=scratch_dir(spark, "bench-many"))
    jobs.run_tag_jobs(spark, many, many_store, EXECUTE_DATE)
    begin = time.time()
    timed("merge60_job", lambda: jobs.run_merge_job(spark, many, many_store, EXECUTE_DATE))
    if timings is not None:
        timings["merge60_span"] = (begin * 1000, time.time() * 1000)
    timed("probe4_tags_union_pivot", probe_wide)
    timed("probe4_unpivot_bitmap_cardinality", probe_bitmaps)
    holder["wide"].unpersist()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # Stage/task times and shuffle bytes, see tools/eventlog_summary.py.
    log_dir = os.environ.get("BENCH_EVENT_LOG") or tempfile.mkdtemp(prefix="tagweave-bench-")
    conf = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
    spark = get_session(
        f"local[{cpus}]", app_name="tagweave-bench", shuffle_partitions=int(cpus), conf=conf
    )
    if os.path.isdir(WARMUP_DIR) and os.path.abspath(sf_dir) != WARMUP_DIR:
        run(spark, WARMUP_DIR, None)  # JIT / class loading, not timed
    passes = int(os.environ.get("BENCH_PASSES", "3"))
    results = []
    for _ in range(passes):
        timings: dict[str, float] = {}
        run(spark, sf_dir, timings)
        day = [k for k in timings if not k.startswith(("probe4_", "merge60_"))]
        results.append((round(sum(timings[k] for k in day), 3), timings))
    # Report the pass with the median total (shared VMs are noisy).
    total, timings = sorted(results, key=lambda r: r[0])[len(results) // 2]
    span = timings.pop("merge60_span")
    spark.stop()
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "profile_day_total",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "sf": sf,
                "cpus": int(cpus),
                "merge60_shuffle_bytes": shuffle_bytes(log_dir, *span),
                "pass_totals": [r[0] for r in results],
            }
        )
    )


if __name__ == "__main__":
    main()
