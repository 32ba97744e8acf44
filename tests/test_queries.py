import os

import pytest
from compare import same

from mergestone.plans import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables are not here")


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    same(spark, registry.QUERIES[name], registry.ORACLE_SQL[name], FOLDER)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert registry.QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 100
    assert set(registry.QUERIES) <= set(__spark_entry__.queries())


def test_approximate_distinct_is_near(spark):
    exact = spark.read.parquet(f"{FOLDER}/lineitem.parquet").select("l_partkey").distinct().count()
    assert abs(registry.QUERIES["approx_distinct"](spark, FOLDER).first()["parts"] - exact) <= 0.05 * exact


def test_filters_and_columns_reach_the_scan(spark):
    plan = registry.QUERIES["scan_filter_project_limit"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_quantity)" in plan and "l_comment" not in plan
    assert "l_tax" not in plan.split("ReadSchema")[-1]


@pytest.mark.parametrize(("name", "parts"), [("part_prune_range", "0,1"), ("part_prune_year", "1,2"), ("part_prune_hash", "0"), ("part_select_named", "1,2")])
def test_pruned_queries_read_only_their_folders(spark, name, parts):
    plan = registry.QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_part" in plan or "PartitionFilters: [_part" in plan
    found = plan.split("PartitionFilters:")[-1].split("PushedFilters")[0]
    assert all(p in found for p in parts.split(",")) and not any(p in found.replace("_part#", "") and f" {p}" in found for p in "3")
