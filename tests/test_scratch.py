from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from metaenrich.plans import catalogue, views
from metaenrich.sources import scratch


def session(master, folder=None):
    """A stand-in with the settings that shared_dir() looks at."""
    conf = SimpleNamespace(get=lambda key, default=None: folder)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        scratch.shared_dir(session("spark://host:7077"))
    assert scratch.shared_dir(session("spark://host:7077", "hdfs://x/y/")) == "hdfs://x/y"
    assert scratch.shared_dir(session("local[2]")) == scratch.shared_dir(session("local[4]"))


def test_tables_live_until_cleared(spark):
    held = scratch.Scratch(spark, "test")
    frame = held.save(spark.range(10).withColumn("x", F.col("id") % 3), "a")
    assert frame.count() == 10
    system, path = held.file_system()
    assert system.exists(path("a"))
    scratch.clear_scratch()
    assert not system.exists(path("a")) and not scratch._OPEN


def test_shuffle_cleanup_is_set_for_the_step_only(spark):
    before = spark.conf.get(scratch._CLEANUP, None)
    with scratch.tidy(spark):
        assert spark.conf.get(scratch._CLEANUP) == "true"
    assert spark.conf.get(scratch._CLEANUP, None) == before


def test_costly_work_on_customers_is_dealt_to_all_tasks(spark, tables):
    for name in ("schema_validation", "record_validation", "nested_validation"):
        assert catalogue.queries()[name](spark, tables).rdd.getNumPartitions() >= 4


def test_lookup_lines_are_dealt_to_all_tasks_and_the_registry_is_read_once(spark, tables):
    assert views.lookup_lines(spark, tables).rdd.getNumPartitions() >= 4
    registry = catalogue._registry(spark, tables)
    assert registry.inputFiles() and all(f.endswith(".parquet") for f in registry.inputFiles())
