"""Lineage cuts delete the shuffle files of what they write."""

import time

import pytest
from pyspark.sql import functions as F

from linkframe.plans import lineage


def _shuffles(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def test_a_cut_leaves_no_shuffle_files(spark):
    held = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    before, setting = _shuffles(spark), spark.conf.get(lineage._CLEANUP, "false")
    cut = lineage.Scratch(spark, "test").cut(held)
    until = time.time() + 20
    while _shuffles(spark) > before and time.time() < until:
        time.sleep(0.1)
    assert _shuffles(spark) <= before
    assert spark.conf.get(lineage._CLEANUP, "false") == setting
    assert sorted(held.collect()) == sorted(cut.collect())


def test_cuts_at_the_same_time_restore_the_setting(spark):
    setting = spark.conf.get(lineage._CLEANUP, "false")
    with lineage.shuffles_deleted(spark):
        with pytest.raises(ValueError, match="inner"), lineage.shuffles_deleted(spark):
            raise ValueError("inner")
        assert spark.conf.get(lineage._CLEANUP) == "true"
    assert spark.conf.get(lineage._CLEANUP, "false") == setting
