"""Sample catalog over the sample warehouse (customer, nation, orders, events).

Ten tags covering the four value types, pass-through, exact and predicate
labels, a window-function SQL and a disabled task. Label names are the
``tag_name`` of leaf tags (no task of their own).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tagweave.sources.catalog import Catalog

EXECUTE_DATE = "2024-01-15"
# Warehouse tables the sample tag SQL reads.
SEED_TABLES = ("customer", "nation", "orders", "lineitem", "events")

# (id = task id, tag_code, tag_value_type, task_status, SQL)
SEED_TAGS = [
    (1, "TAG_CUST_SEGMENT", "3", "1",
     "select cast(c_custkey as string) uid, c_mktsegment query_value from customer"),
    (2, "TAG_ORDER_COUNT", "1", "1",
     "select cast(o_custkey as string) uid, count(*) query_value from orders "
     "where cast(o_orderdate as date) <= cast('executeDate' as date) group by o_custkey"),
    (3, "TAG_ORDER_SPEND", "2", "1",
     "select cast(o_custkey as string) uid, "
     "cast(sum(cast(o_totalprice as decimal(16,2))) as decimal(16,2)) query_value from orders "
     "where cast(o_orderdate as date) <= cast('executeDate' as date) group by o_custkey"),
    (4, "TAG_ORDER_LAST", "4", "1",
     "select cast(o_custkey as string) uid, cast(max(cast(o_orderdate as date)) as string) query_value "
     "from orders where cast(o_orderdate as date) <= cast('executeDate' as date) group by o_custkey"),
    (5, "TAG_CUST_REGION", "3", "1",
     "select cast(c_custkey as string) uid, n_regionkey query_value "
     "from customer join nation on c_nationkey = n_nationkey"),
    (6, "TAG_PERSON_BASE_CONS", "3", "1",
     "select cast(o_custkey as string) uid, "
     "substr(cast(min(cast(o_orderdate as date)) as string), 6, 5) query_value "
     "from orders group by o_custkey"),
    (7, "TAG_SPEND_BAND", "3", "1",
     "select cast(o_custkey as string) uid, sum(cast(o_totalprice as decimal(16,2))) query_value "
     "from orders group by o_custkey"),
    (8, "TAG_EVENT_COUNT", "1", "1",
     "select cast(user_id as string) uid, count(*) query_value from events "
     "where cast(ts as date) <= cast('executeDate' as date) group by user_id"),
    (9, "TAG_LATEST_PRIORITY", "3", "1",
     "select uid, query_value from (select cast(o_custkey as string) uid, o_orderpriority query_value, "
     "row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) rn "
     "from orders) r where rn = 1"),
    (10, "TAG_EVENT_TOP", "3", "0",
     "select uid, query_value from (select cast(user_id as string) uid, event_type query_value, "
     "row_number() over (partition by user_id order by count(*) desc, event_type) rn "
     "from events group by user_id, event_type) r where rn = 1"),
]

# Leaf tags that name labels: (id, tag_name)
SEED_LABELS = [
    (101, "AFRICA"), (102, "AMERICA"), (103, "ASIA"), (104, "EUROPE"),
    (111, "Capricorn"), (112, "Aquarius"), (113, "Pisces"), (114, "Aries"),
    (115, "Taurus"), (116, "Gemini"), (117, "Cancer"), (118, "Leo"),
    (119, "Virgo"), (120, "Libra"), (121, "Scorpio"), (122, "Sagittarius"),
    (131, "high"), (132, "mid"), (133, "low"),
]

# Rules in first-match order: (rule id, task id, query_value, sub_tag_id, match_mode)
SEED_RULES = [
    (1, 5, "0", 101, None),
    (2, 5, "1", 102, None),
    (3, 5, "2", 103, None),
    (4, 5, "3", 104, None),
    (5, 5, "4", 999, None),  # leaf 999 does not exist: dropped by the rule join
    (6, 6, "between '12-22' and '12-31'", 111, None),
    (7, 6, "between '01-01' and '01-19'", 111, None),
    (8, 6, "between '01-20' and '02-18'", 112, None),
    (9, 6, "between '02-19' and '03-20'", 113, None),
    (10, 6, "between '03-21' and '04-19'", 114, None),
    (11, 6, "between '04-20' and '05-20'", 115, None),
    (12, 6, "between '05-21' and '06-20'", 116, None),
    (13, 6, "between '06-21' and '07-22'", 117, None),
    (14, 6, "between '07-23' and '08-22'", 118, None),
    (15, 6, "between '08-23' and '09-22'", 119, None),
    (16, 6, "between '09-23' and '10-22'", 120, None),
    (17, 6, "between '10-23' and '11-21'", 121, None),
    (18, 6, "between '11-22' and '12-21'", 122, None),
    (19, 7, ">= 3000000", 131, "predicate"),
    (20, 7, ">= 1500000", 132, "predicate"),
    (21, 7, ">= 0", 133, "predicate"),
]


def seed_records(
    tags=SEED_TAGS, labels=SEED_LABELS, rules=SEED_RULES, status_overrides: dict | None = None,
    sql_overrides: dict | None = None,
):
    """Catalog rows (tag_info, task_info, task_tag_rule) as dicts."""
    status_overrides = status_overrides or {}
    sql_overrides = sql_overrides or {}
    tag_rows, task_rows = [], []
    for tid, code, vtype, status, sql in tags:
        tag_rows.append(
            {"id": tid, "tag_code": code, "tag_name": code.lower(), "tag_level": 3,
             "tag_value_type": vtype, "tag_task_id": tid}
        )
        task_rows.append(
            {"id": tid, "task_name": code.lower(), "task_status": status_overrides.get(tid, status),
             "task_sql": sql_overrides.get(tid, sql), "task_type": "tag"}
        )
    for lid, name in labels:
        tag_rows.append({"id": lid, "tag_code": f"LEAF_{lid}", "tag_name": name, "tag_level": 4})
    rule_rows = [
        {"id": rid, "task_id": task, "tag_id": task, "query_value": q, "sub_tag_id": leaf,
         "match_mode": mode}
        for rid, task, q, leaf, mode in rules
    ]
    return tag_rows, task_rows, rule_rows


def seed_catalog(spark: SparkSession, **kwargs) -> Catalog:
    return Catalog.from_rows(spark, *seed_records(**kwargs))
