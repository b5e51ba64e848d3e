"""Every query with SQL gives the rows that DuckDB gives for the SQL."""

import os

import pytest

from cartoria.plans import integration, registry, review, screening, spatial_queries

MODULES = [registry, screening, review, integration, spatial_queries]
QUERIES = {name: (m.QUERIES[name], m.SQL.get(name)) for m in MODULES for name in m.QUERIES}


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables here")
def test_matches_sql(name, compare):
    query, sql = QUERIES[name]
    compare(query, sql)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables here")
def test_entities_are_consistent(spark):
    clusters = review.entity_clusters(spark, "/root/testdata/sf0.001").collect()
    group = {r["pos"]: r["grupo"] for r in clusters}
    assert all(group[p["a"]] == group[p["b"]] for p in review.entity_links(spark, "/root/testdata/sf0.001").collect())
    survivors = review.entity_survivor(spark, "/root/testdata/sf0.001")
    total = review.entity_rows(spark, "/root/testdata/sf0.001").count()
    assert survivors.agg({"registros": "sum"}).first()[0] == total


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables here")
def test_geojson_is_written_whole_both_times(spark, monkeypatch):
    written, write = [], integration.write_geojson
    monkeypatch.setattr(integration, "write_geojson", lambda *a, pretty=False: written.append((pretty, write(*a, pretty=pretty))))
    n = integration.geojson_round_trip(spark, "/root/testdata/sf0.001").count()
    assert n > 0 and written == [(False, n), (True, n)]


def test_entry_points():
    import __spark_entry__ as e

    names = e.queries()
    assert set(e.oracle_sql()) <= set(names)
    assert {f"p{n}_found" for n in (1,)} <= set(names)
