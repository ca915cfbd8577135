"""Merkle manifest of a documents table: a tree per source, and one over the sources' subroots.

Nodes of a level are rows (group, position, digest). A parent's children are spread
into ``FANOUT`` columns by conditional aggregates (column i: the child of slot i);
its digest hashes the concatenated columns. For a child of slot i the columns before
and after i, its own left out, are its siblings. So the tree is built upwards by one
aggregation a level, and downwards every parent's path (siblings of all levels up to
the root) goes to its children; leaves meet it in the join that ends the query, so a
path is stored once for all children of a parent and never for a leaf.

Positions come from a range partitioning with a row number per partition and prefix
sums over partitions: a source may hold any share of the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagweave.llm.common import BROADCAST_ROWS, written

FANOUT = 16
#: Columns of a leaf, in the order they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A level of the path: digests of the siblings before and after the node.
STEP = "struct<before:string,after:string>"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_UP = f"pos div {FANOUT}"  # the parent's position
_ROW_BITS = 33  # of monotonically_increasing_id: the row's number in its partition


def _framed(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(text: str | Column = "text") -> Column:
    """A document's leaf, with the given text."""
    return _hash(*[_framed(F.col(c)) for c in FIELDS[:-1]], _framed(F.col(text) if isinstance(text, str) else text))


def with_positions(nodes: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """``nodes`` with ``pos``, 0, 1, 2... within ``group`` by ``order`` (nulls first), and the group's ``size``."""
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = written(
        nodes.repartitionByRange(parts, group, *order)
        .sortWithinPartitions(group, *order)
        .withColumn("_at", F.monotonically_increasing_id()),
        f"{label}-placed",
    ).withColumn("_part", F.shiftright("_at", _ROW_BITS))
    # One row per group and partition it has rows in.
    runs = placed.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_k"))
    own = Window.partitionBy(group)
    before = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = written(
        runs.select(
            group, "_part", "_first", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_base"), F.sum("_k").over(own).alias("size")
        ),
        f"{label}-runs",
    )
    if runs.count() <= BROADCAST_ROWS:  # about one a partition and group
        runs = F.broadcast(runs)
    return placed.join(runs, [group, "_part"]).select(*nodes.columns, (F.col("_at") - F.col("_first") + F.col("_base")).alias("pos"), "size")


def _slots(children: DataFrame, group: str) -> DataFrame:
    """A row per parent: group, pos, s0 ... s15 (absent children: empty text), digest."""
    columns = [f"s{i}" for i in range(FANOUT)]
    slot = F.pmod("pos", F.lit(FANOUT))
    spread = children.groupBy(group, F.expr(_UP).alias("pos")).agg(
        *[F.coalesce(F.max(F.when(slot == i, F.col("digest"))), F.lit("")).alias(c) for i, c in enumerate(columns)], F.first("size").alias("size")
    )
    return spread.withColumn("digest", _hash(*[F.col(c) for c in columns])).withColumn("size", F.ceil(F.col("size") / FANOUT))


def build_levels(leaves: DataFrame, group: str, label: str) -> list[DataFrame]:
    """Parents level by level, each a written table (group, pos, s0..s15, size, digest).

    ``leaves``: (group, pos, digest, size). A group leaves the table above the level
    where it has one node. The last levels are ever smaller: a sixteenth each.
    """
    levels: list[DataFrame] = []
    below = leaves
    while not (growing := below.where("size > 1")).isEmpty():
        below = written(_slots(growing.select(group, "pos", "digest", "size"), group), f"{label}-level{len(levels) + 1}")
        levels.append(below)
    return levels


def _with_path(children: DataFrame, parents: DataFrame, group: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Children of one level with ``path``: their siblings, then their parent's path (and its columns ``carry``).

    The siblings are all columns of the parent but the one of the child's own slot. A join key has at most ``FANOUT`` children.
    """
    up = parents.select(
        group, F.col("pos").alias("_up"), F.col("path").alias("_above"), *[F.col(f"s{i}").alias(f"p{i}") for i in range(FANOUT)], *carry
    )
    slot = F.pmod("pos", F.lit(FANOUT))
    before = F.concat(*[F.when(slot > i, F.col(f"p{i}")).otherwise("") for i in range(FANOUT)])
    after = F.concat(*[F.when(slot < i, F.col(f"p{i}")).otherwise("") for i in range(FANOUT)])
    step = F.struct(before.alias("before"), after.alias("after"))
    joined = children.withColumn("_up", F.expr(_UP)).join(up, [group, "_up"])
    return joined.select(*children.columns, *carry, F.concat(F.array(step), F.col("_above")).alias("path"))


def _paths_down(levels: list[DataFrame], tops: DataFrame, group: str, label: str) -> DataFrame | None:
    """The lowest parents with their paths to the root. ``tops``: (group, path) of every group's one last node."""
    paths = None
    for i in range(len(levels) - 1, -1, -1):
        level = levels[i]
        ends = level.where("size = 1").join(tops, group).select(*level.columns, "path")
        if paths is not None:
            ends = ends.unionByName(_with_path(level.where("size > 1"), paths, group))
        paths = written(ends, f"{label}-path{i + 1}")
    return paths


def _tops(leaves: DataFrame, levels: list[DataFrame], group: str) -> DataFrame:
    """(group, digest) of every group's one last node."""
    return reduce(DataFrame.unionByName, [t.where("size = 1").select(group, "digest") for t in [leaves, *levels]])


def fold(digest: Column, path: Column) -> Column:
    """The root recomputed from a leaf and the siblings on its path."""
    return F.aggregate(path, digest, lambda acc, step: F.sha2(F.concat(step["before"], acc, step["after"]), 256))


def proof_digest(path: Column) -> Column:
    """H of all siblings on a path, level by level, left to right."""
    return _hash(F.concat_ws("", F.flatten(F.transform(path, lambda step: F.array(step["before"], step["after"])))))


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    The leaf hashes ``FIELDS``; per source (null is a source of its own) leaves ascend by doc_id, null
    first, equal ones by leaf, so repeated rows have places of their own. Where ``tampered`` (a
    condition on ``docs``) holds, the folded root starts from the leaf with its text's A-Z
    lower-cased; null texts stay. Rows of empty tables: none. Only ``FIELDS`` (and what
    ``tampered`` reads) are used.
    """
    tampered = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    leaf = leaf_digest()
    changed = F.when(tampered, leaf_digest(F.translate("text", _UPPER, _LOWER))).otherwise(leaf)
    # Source as a key that is never null, so that joins on it keep the null source.
    rows = written(
        docs.select(F.col("doc_id"), F.col("source"), _framed(F.col("source")).alias("g"), leaf.alias("digest"), changed.alias("given")),
        "merkle-leaves",
    )
    leaves = written(with_positions(rows, "g", ["doc_id", "digest", "given"], "merkle"), "merkle-positions")
    levels = build_levels(leaves.select("g", "pos", "digest", "size"), "g", "merkle")

    source = leaves.where("pos = 0").select("g", "source")
    subroots = written(_tops(leaves, levels, "g").join(source, "g"), "merkle-subroots")
    one = subroots.withColumn("all", F.lit(0))
    upper = written(with_positions(one, "all", ["source"], "merkle-sources"), "merkle-sources")
    upper_levels = build_levels(upper.select("all", "pos", "digest", "size"), "all", "merkle-sources")
    root = _tops(upper, upper_levels, "all").select("all", F.col("digest").alias("root"))
    empty = F.expr(f"cast(array() as array<{STEP}>)").alias("path")
    tops = root.select("all", empty)
    top_paths = _paths_down(upper_levels, tops, "all", "merkle-sources")
    with_root = upper.join(F.broadcast(root), "all")  # one row
    if top_paths is None:  # one source: its subroot is the root
        with_root = with_root.select("*", empty)
    else:
        with_root = _with_path(with_root, top_paths, "all")
    sources = written(with_root.select("g", F.col("digest").alias("subroot"), "root", "path"), "merkle-source-paths")

    ends = _counted(sources.select("g", "subroot", "root"))
    paths = _paths_down([t.join(ends, "g") for t in levels], sources.select("g", "path"), "g", "merkle")
    columns = ["doc_id", "digest", "given", "subroot", "root", "path"]
    done = leaves.where("size = 1").join(_counted(sources), "g").select(columns)
    if paths is not None:
        below = leaves.where("size > 1").select("g", "pos", "doc_id", "digest", "given")
        done = done.unionByName(_with_path(below, paths, "g", ("subroot", "root")).select(columns))
    folded = fold(F.col("given"), F.col("path"))
    return done.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _counted(keys: DataFrame) -> DataFrame:
    """A written table of one row a source, broadcast only behind a count."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS // 100 else keys
