"""Bitmap job: wide table -> (tag, value) pairs -> uid bitmap per pair.

Per value type (long, decimal, string, date) one table
``tag_code, tag_value <T>, bucket, n, uids, uid_list, dt`` holds, for every
(tag, value), the set of uids that have it, split by 32768-id buckets:

* ``n``        - how many ids the row holds;
* ``uids``     - Spark's 4096-byte bitmap of the bucket, for groups of more than
  ``sparse_max`` ids (the default 512 ids x 8 bytes = one bitmap);
* ``uid_list`` - the sorted ids themselves, for smaller groups (an id from 2^63 on as the
  BIGINT of the same bits).

Exactly one of the two is set, decided by the group's ids alone: the same input
gives the same rows whatever the route or the store's history. States of several
dates or slices are united with :func:`merge_states`.

Routes to the same rows (``layout``):

* ``bitmap`` - aggregated as bitmaps, with map-side partial bitmaps: on
  uid-clustered input a dense value costs ~1 bit per uid in the shuffle, but a
  value held by one uid costs a whole 4 KB bitmap there;
* ``hybrid`` - positions are shuffled once (~8 bytes per uid): right for tags
  whose values are nearly unique per uid (a spend amount, a date);
* ``auto`` (default) - per-tag statistics (ids and (value, bucket) groups,
  one row per tag to the driver) send a tag to ``bitmap`` when its bitmaps
  would be well filled on average and to ``hybrid`` otherwise. Groups, not
  values, are counted: five values over sparse (e.g. hashed) ids still mean
  one nearly empty bitmap per id.

Hot keys: the group key includes the bucket, so no group holds more than
32768 ids, however many uids share one value.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.codes import BITMAP_TABLES, TYPE_STRING, CatalogError, value_type
from tagweave.functions.bitmap import (
    bit_position,
    bucket_number,
    construct_agg,
    expand_bitmap_batches,
    store_batches,
    unsigned,
)

GROUP_KEYS = ["tag_code", "tag_value", "bucket"]
SPARSE_MAX = 512


def bitmap_schema(type_code: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField("tag_code", T.StringType()),
            T.StructField("tag_value", value_type(type_code)),
            T.StructField("bucket", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("uids", T.BinaryType()),
            T.StructField("uid_list", T.ArrayType(T.LongType())),
        ]
    )


def route_by_type(tags: Sequence) -> dict[str, list]:
    """Enabled tags split by value type; every type present, maybe empty."""
    routed: dict[str, list] = {code: [] for code in BITMAP_TABLES}
    for tag in tags:
        code = str(tag["tag_value_type"])
        if code not in routed:
            raise CatalogError(f"tag {tag['tag_code']}: unknown tag_value_type {code!r}")
        routed[code].append(tag)
    return routed


def unpivot_tags(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(uid, tag_code, tag_value)`` per non-empty cell of ``columns``.

    ``explode`` of an array of (code, value) structs over each wide row: no
    shuffle. Empty text and NULL are the same "no value" state and
    are dropped here, before any cast.
    """
    columns = list(columns)
    if not columns:
        return wide.select(
            "uid",
            F.lit(None).cast("string").alias("tag_code"),
            F.lit(None).cast("string").alias("tag_value"),
        ).limit(0)
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("tag_code"), F.col(c).cast("string").alias("tag_value"))
            for c in columns
        ]
    )
    long = wide.select("uid", F.explode(cells).alias("_cell")).select(
        "uid", F.col("_cell.tag_code").alias("tag_code"), F.col("_cell.tag_value").alias("tag_value")
    )
    return long.where(F.col("tag_value").isNotNull() & (F.col("tag_value") != F.lit("")))


def uid_to_long(pairs: DataFrame, on_bad: str = "error") -> DataFrame:
    """uid text -> unsigned 64-bit id, as the BIGINT of the same bits.

    NULL, negative, non-numeric or out-of-range uids raise (default) or,
    with ``on_bad="drop"``, are left out. Runs inside the codegen stage; only
    ids from 2^63 on go through decimals.
    """
    low = F.col("uid").try_cast(T.LongType())
    digits = F.trim(F.col("uid"))
    wide = F.when(digits.rlike("^[0-9]{19,20}$"), digits.try_cast("decimal(20,0)"))
    wrapped = F.when(wide < F.lit(str(1 << 64)).cast("decimal(20,0)"), wide - F.lit(str(1 << 64)).cast("decimal(20,0)")).cast(T.LongType())
    parsed = F.when(low.isNull(), wrapped).when(low >= 0, low)
    if on_bad == "drop":
        return pairs.withColumn("uid", parsed).where(F.col("uid").isNotNull())
    if on_bad != "error":
        raise ValueError("on_bad must be 'error' or 'drop'")
    message = F.concat(F.lit("bitmap: invalid uid "), F.coalesce(F.col("uid"), F.lit("NULL")))
    return pairs.withColumn("uid", F.coalesce(parsed, F.raise_error(message).cast(T.LongType())))


def typed_value(pairs: DataFrame, type_code: str) -> DataFrame:
    """Text value -> the type of the bitmap table; unparsable text raises."""
    target = value_type(type_code)
    if isinstance(target, T.StringType):
        return pairs
    parsed = F.col("tag_value").try_cast(target)
    message = F.concat(
        F.lit("bitmap: value "), F.col("tag_value"), F.lit(f" is not {target.simpleString()}")
    )
    return pairs.withColumn(
        "tag_value", F.when(parsed.isNull(), F.raise_error(message)).otherwise(parsed)
    )


# ``auto``: a tag whose (value, bucket) groups hold at least this many ids on
# average - a bitmap at least 1/16 full, under 2 bytes per id - is built with
# map-side partial bitmaps.
DENSE_MIN_IDS_PER_GROUP = 2048


def _stored(groups: DataFrame, sparse_max: int, ids: bool = False) -> DataFrame:
    """Groups (keys, ``uids``, ``positions``) in their stored form, in Arrow batches, without a shuffle."""
    keys = [groups.schema[k] for k in GROUP_KEYS]
    schema = T.StructType([*keys, *[f for f in bitmap_schema(TYPE_STRING).fields if f.name in ("n", "uids", "uid_list")]])
    return groups.mapInArrow(lambda batches: store_batches(batches, GROUP_KEYS, sparse_max, ids), schema)


def _bitmap_layout(located: DataFrame, sparse_max: int) -> DataFrame:
    groups = located.groupBy(*GROUP_KEYS).agg(construct_agg(F.col("pos")).alias("uids"))
    return _stored(groups.withColumn("positions", F.lit(None).cast("array<bigint>")), sparse_max)


def _hybrid_layout(located: DataFrame, sparse_max: int) -> DataFrame:
    """One shuffle of positions and one aggregate per group (at most 32768 ids)."""
    groups = located.groupBy(*GROUP_KEYS).agg(F.collect_set("pos").alias("positions"))
    return _stored(groups.withColumn("uids", F.lit(None).cast("binary")), sparse_max)


def _dense(stats: DataFrame, min_ids_per_group: int) -> list[str]:
    return sorted(
        r["tag_code"]
        for r in stats.collect()
        if r["n"] >= min_ids_per_group * max(int(r["groups"]), 1)
    )


def dense_tags(pairs: DataFrame, min_ids_per_group: int = DENSE_MIN_IDS_PER_GROUP) -> list[str]:
    """Tags whose (value, bucket) groups hold ``min_ids_per_group`` ids on average.

    ``pairs``: ``tag_code, tag_value, uid BIGINT``. A partial + final
    aggregate with an HLL sketch per tag; one row per tag comes back.
    """
    group = F.xxhash64(F.col("tag_value"), bucket_number(F.col("uid")))
    stats = pairs.groupBy("tag_code").agg(
        F.count("*").alias("n"), F.approx_count_distinct(group).alias("groups")
    )
    return _dense(stats, min_ids_per_group)


def dense_from_bitmaps(
    bitmaps: DataFrame, min_ids_per_group: int = DENSE_MIN_IDS_PER_GROUP
) -> list[str]:
    """``dense_tags`` from already built bitmap rows (e.g. a previous date).

    Each stored row is one (value, bucket) group; only tag and count are read
    and one row per tag comes back.
    """
    stats = bitmaps.groupBy("tag_code").agg(F.sum("n").alias("n"), F.count("*").alias("groups"))
    return _dense(stats, min_ids_per_group)


def build_bitmaps(
    pairs: DataFrame,
    layout: str = "auto",
    sparse_max: int = SPARSE_MAX,
    dense_min_ids_per_group: int = DENSE_MIN_IDS_PER_GROUP,
    dense: Sequence[str] | None = None,
) -> DataFrame:
    """Distinct uid set per (tag_code, tag_value), one row per bucket.

    ``pairs`` has ``tag_code, tag_value, uid BIGINT`` (see :func:`uid_to_long`). For
    ``auto``, ``dense`` may give the dense tags already (see ``dense_tags``).
    """
    located = pairs.select(
        "tag_code",
        "tag_value",
        bucket_number(F.col("uid")).alias("bucket"),
        bit_position(F.col("uid")).alias("pos"),
    )
    if layout == "bitmap":
        return _bitmap_layout(located, sparse_max)
    if layout == "hybrid":
        return _hybrid_layout(located, sparse_max)
    if layout != "auto":
        raise ValueError("layout must be 'auto', 'hybrid' or 'bitmap'")
    if dense is None:
        dense = dense_tags(pairs, dense_min_ids_per_group)
    dense = list(dense)
    if not dense:
        return _hybrid_layout(located, sparse_max)
    is_dense = F.col("tag_code").isin(dense)
    return _bitmap_layout(located.where(is_dense), sparse_max).unionByName(
        _hybrid_layout(located.where(~is_dense), sparse_max)
    )


def bitmap_slice(
    wide: DataFrame,
    tags: Sequence,
    type_code: str,
    layout: str = "auto",
    on_bad_uid: str = "error",
    sparse_max: int = SPARSE_MAX,
    dense_min_ids_per_group: int = DENSE_MIN_IDS_PER_GROUP,
    dense: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of one typed bitmap table for the wide table's date.

    Only the uid and the columns of this type are read from the wide table;
    with ``auto`` the dense and the other columns are two scans of disjoint
    column sets, each with its own layout.
    """
    columns = [t["tag_code"].lower() for t in tags]

    def rows(cols: list[str], how: str) -> DataFrame:
        pairs = typed_value(uid_to_long(unpivot_tags(wide, cols), on_bad_uid), type_code)
        return build_bitmaps(pairs, layout=how, sparse_max=sparse_max)

    if layout == "auto":
        if dense is None:
            dense = dense_tags(uid_to_long(unpivot_tags(wide, columns), on_bad_uid), dense_min_ids_per_group)
        dense_cols = [c for c in columns if c in set(dense)]
        other_cols = [c for c in columns if c not in set(dense)]
        parts = ([rows(dense_cols, "bitmap")] if dense_cols else []) + (
            [rows(other_cols, "hybrid")] if other_cols or not dense_cols else []
        )
        out = reduce(DataFrame.unionByName, parts)
    else:
        out = rows(columns, layout)
    schema = bitmap_schema(type_code)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def merge_states(bitmaps: DataFrame, sparse_max: int = SPARSE_MAX) -> DataFrame:
    """Union of states: one row per (tag, value, bucket) over all dates or slices given.

    Bitmaps are united as bitmaps, with map-side combine; id lists are gathered by
    group (at most ``sparse_max`` ids a state). Both sides then have one row per group
    and the same partitioning, so bringing them together shuffles nothing more.
    """
    dense = bitmaps.where(F.col("uids").isNotNull()).groupBy(*GROUP_KEYS).agg(F.call_function("bitmap_or_agg", F.col("uids")).alias("uids"))
    listed = bitmaps.where(F.col("uid_list").isNotNull()).groupBy(*GROUP_KEYS).agg(F.flatten(F.collect_list("uid_list")).alias("positions"))
    return _stored(dense.join(listed, GROUP_KEYS, "full_outer").select(*GROUP_KEYS, "uids", "positions"), sparse_max, ids=True)


def _one_state(bitmaps: DataFrame, keys: Sequence[str]) -> bool:
    """Whether each group has one row per key: a single date's rows carry no ``dt``."""
    return "dt" not in bitmaps.columns or "dt" in keys


def cardinality(bitmaps: DataFrame, keys: Sequence[str] = ("tag_code", "tag_value")) -> DataFrame:
    """Number of distinct uids per (tag, value): the sum of ``n`` over buckets.

    For one date only counts are read. Rows of several dates (with ``dt``, and
    ``dt`` not among the keys) are united first, so a uid counts once.
    """
    states = bitmaps if _one_state(bitmaps, keys) else merge_states(bitmaps)
    return states.groupBy(*keys).agg(F.sum("n").cast("bigint").alias("cardinality"))


def _stored_ids(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., uid): every id stored, as often as it is stored."""
    keys = list(dict.fromkeys([*keys, "bucket"]))
    listed = bitmaps.where(F.col("uid_list").isNotNull()).select(*keys, F.explode("uid_list").alias("uid"))
    dense = bitmaps.where(F.col("uids").isNotNull()).select(*keys, "uids")
    schema = T.StructType([*[bitmaps.schema[k] for k in keys], T.StructField("uid", T.LongType())])
    expanded = dense.mapInArrow(lambda batches: expand_bitmap_batches(batches, keys), schema)
    return listed.unionByName(expanded)


def decode(
    bitmaps: DataFrame, keys: Sequence[str] = ("tag_code", "tag_value"), all_unsigned: bool = False
) -> DataFrame:
    """One row per distinct (tag, value, uid) stored in the bitmaps.

    Id lists explode on the JVM; bitmaps expand in Arrow batches (Spark has
    no built-in to list a bitmap's bits). No shuffle for one date; rows of
    several dates are united first. uid is a BIGINT, and one from 2^63 on raises; with
    ``all_unsigned`` it is a DECIMAL(20,0) and holds every unsigned 64-bit id.
    """
    states = bitmaps if _one_state(bitmaps, keys) else merge_states(bitmaps)
    uid = F.col("uid")
    if all_unsigned:
        value = unsigned(uid)
    else:
        message = F.concat(F.lit("uid "), unsigned(uid).cast("string"), F.lit(" is no BIGINT: decode with all_unsigned=True"))
        value = F.when(uid < 0, F.raise_error(message)).otherwise(uid).cast(T.LongType())
    return _stored_ids(states, keys).select(*keys, value.alias("uid"))
