"""Costly work on single rows is shared out by the number of rows, whatever the row groups of a file."""

import os

import pytest
from pyspark.sql import functions as F

from catalog.lake import Lake
from odolake.session import spread

SF = "/root/testdata/sf0.001"


def sizes(df):
    rows = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n")).collect()
    return [r.n for r in rows]


@pytest.fixture
def many_splits(spark):
    """More splits than cores are planned for a file whose rows are all in one row group, so in one split."""
    names = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "0"}
    old = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_one_row_group_is_inspected_by_many_tasks(spark, many_splits):
    bronze = Lake(spark, SF).bronze
    assert bronze.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism and len(sizes(bronze)) == 1
    found = sizes(Lake(spark, SF).inspected)
    assert sum(found) == bronze.count()
    assert max(found) <= 2 * bronze.count() / spark.sparkContext.defaultParallelism


def test_tasks_follow_the_rows(spark, tmp_path):
    spark.range(4000).coalesce(1).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    for keys in ((), ("id",)):
        found = sizes(spread(rows, *keys, rows_per_task=100))
        assert len(found) == 40 and max(found) <= 200 and sum(found) == 4000
    assert spread(rows, least=1).rdd.getNumPartitions() == rows.rdd.getNumPartitions()
