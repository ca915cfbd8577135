"""What operators leave on disk: no shuffle files of their writes, no table that nothing reads any more."""

import os

from pyspark.sql import functions as F

from tagweave.llm import chunk_dedup
from tagweave.llm.common import CLEANUP, table, written
from tagweave.llm.jaccard import jaccard_components
from tagweave.llm.suffix_dedup import remove_repeated_strings
from tagweave.session import shared_root

from .conftest import SF


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().endswith(".data")}


def scratch(spark):
    root = os.path.join(shared_root(spark).removeprefix("file:"), "tagweave")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_written_leaves_no_shuffle_files(spark):
    setting, before = spark.conf.get(CLEANUP), shuffle_files(spark)
    found = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "few")
    assert not shuffle_files(spark) - before
    assert found.where("k < 3").collect() and spark.conf.get(CLEANUP) == setting


def test_operators_drop_their_scratch(spark):
    docs = table(spark, SF, "documents")
    for operator, kept in (
        (remove_repeated_strings, {"suffix-spans"}),
        (chunk_dedup.remove_repeats, {"chunk-marks"}),
        (jaccard_components, {"jaccard-members", "jaccard-classes", "cc"}),
    ):
        before = scratch(spark)
        assert operator(docs).count() == docs.count()
        left = {"cc" if x.startswith("cc-") else x.rsplit("-", 1)[0] for x in scratch(spark) - before}
        assert left == kept


def test_links_are_shuffled_once(spark):
    pieces = spark.createDataFrame([(1, [5, 6]), (2, [6, 7]), (None, [5]), (3, [7, 6]), (3, [9])], "doc_id long, h array<long>")
    later = chunk_dedup._later_links(pieces)
    assert sorted(map(tuple, later.collect())) == [(2, 6), (3, 6), (3, 7)]
    plan = later._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
