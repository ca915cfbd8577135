"""Print the physical plans of the main operators as Markdown.

    python tools/dump_plans.py /root/testdata/sf0.01 > docs/PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tagweave.operators.bitmap import bitmap_slice, cardinality, decode  # noqa: E402
from tagweave.operators.export import cluster_by_uid  # noqa: E402
from tagweave.operators.tags import build_tag  # noqa: E402
from tagweave.plans import jobs  # noqa: E402
from tagweave.plans.seed import EXECUTE_DATE, seed_catalog  # noqa: E402
from tagweave.session import get_session, scratch_dir  # noqa: E402
from tagweave.sources.store import ProfileStore  # noqa: E402
from tagweave.sources.warehouse import register_parquet_views  # noqa: E402


def tree(df) -> str:
    """The operator tree of the final adaptive plan, paths shortened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("+- == Initial Plan ==")[0]
    plan = re.sub(r"#\d+L?", "", plan)
    plan = re.sub(r"file:[^\],]*", "<path>", plan)
    lines = [ln[:160] for ln in plan.splitlines()]
    return "\n".join(lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    register_parquet_views(spark, sf)
    cat = seed_catalog(spark)
    store = ProfileStore(spark, root=scratch_dir(spark, "plans"))
    jobs.run_day(spark, cat, store, EXECUTE_DATE)
    wide = store.read_wide(EXECUTE_DATE)
    export = store.read_export(EXECUTE_DATE)
    string_tags = [t for t in cat.enabled_tag_rows() if t["tag_value_type"] == "3"]
    sections = [
        ("Tag with a date filter (TAG_ORDER_SPEND)", build_tag(spark, cat, 3, EXECUTE_DATE)),
        ("Tag with exact labels over a join (TAG_CUST_REGION)", build_tag(spark, cat, 5, EXECUTE_DATE)),
        ("Tag with row_number() = 1 (TAG_LATEST_PRIORITY)", build_tag(spark, cat, 9, EXECUTE_DATE)),
        ("Merge: union of 9 slices + pivot", jobs.merge_frame(cat, store, EXECUTE_DATE)),
        ("Export of a wide table the merge job did not store: uid range clustering", cluster_by_uid(wide, 4)),
        ("Bitmaps, hybrid layout (string tags)", bitmap_slice(export, string_tags, "3", layout="hybrid")),
        ("Bitmaps, bitmap layout (string tags)", bitmap_slice(export, string_tags, "3", layout="bitmap")),
        ("Cardinality of a typed table", cardinality(jobs.read_bitmaps(store, "3", EXECUTE_DATE))),
        ("Decode of a typed table", decode(jobs.read_bitmaps(store, "3", EXECUTE_DATE))),
    ]
    print(f"# Physical plans\n\nGenerated by `tools/dump_plans.py` on `{os.path.basename(sf)}`, "
          "`local[8]`, AQE on; final adaptive plans, expression ids and paths removed.\n")
    for title, df in sections:
        print(f"## {title}\n\n```\n{tree(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
