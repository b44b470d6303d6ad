import pytest
from conftest import rows_of

from roadlens import plans

SQL = plans.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    ours, theirs = plans.queries()[name](spark, sf_dir).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)


def test_audit_counts_the_whole_graph(spark, sf_dir):
    rows = plans.queries()["road_network_audit"](spark, sf_dir).collect()
    parts = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_partkey").distinct().count()
    assert 0 < sum(r.n_nodes for r in rows) <= parts
