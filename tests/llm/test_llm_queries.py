"""Every query of problems 2 to 10 on the smallest tables: against its SQL where there is one, else what must hold of its rows."""

import os

import pytest
from pyspark.sql import functions as F

from cartoria.llm import MODULES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
SQL = {name: sql for m in MODULES for name, sql in m.SQL.items()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, compare):
    compare(QUERIES[name], SQL[name])


@pytest.fixture(scope="module")
def rows(spark):
    known = {}

    def get(name):
        if name not in known:
            known[name] = QUERIES[name](spark, DATA).toPandas()
        return known[name]

    return get


@pytest.mark.parametrize(("pairs", "houses", "head"), [("p5_matches", "p5_houses", "casa"), ("p6_found", "p6_houses", "casa"), ("p4_found", "p4_places", "lugar")])
def test_pairs_and_compact_forms_agree(rows, pairs, houses, head):
    p, h = rows(pairs), rows(houses)
    of = dict(zip(h["pos"], h[head]))
    assert not p.duplicated(["pos_a", "pos_b"]).any() and (p["pos_a"] < p["pos_b"]).all()
    assert all(of[a] == of[b] for a, b in zip(p["pos_a"], p["pos_b"]))
    sizes = h.groupby(head)["pos"].agg(["count", "min"])
    assert not h["pos"].duplicated().any() and (h[head].map(sizes["count"]) == h["registros"]).all() and (sizes["min"] == sizes.index).all()


def test_matches_have_a_confidence(rows):
    found, matches = rows("p5_found"), rows("p5_matches")
    assert sorted(map(tuple, found.values)) == sorted(map(tuple, matches[["pos_a", "pos_b"]].values))
    assert matches["confianca"].between(0, 1).all() and (matches["confianca"] > 0).all()


def test_repaired_rows_are_the_found_ones(rows, spark):
    found, repaired = rows("p3_found"), rows("p3_repaired")
    assert sorted(map(tuple, found.values)) == sorted(map(tuple, repaired[["tabela", "pos"]].values)) and len(found)
    stored = {("terreiros_all_sources_v2", r[0]): r[1] for r in spark.read.parquet(f"{DATA}/terreiros_all_sources_v2.parquet").select("pos", "nome").collect()}
    assert all(stored.get((t, p), "") != c for t, p, c in repaired[["tabela", "pos", "corrigido"]].values)


def test_containers(rows, spark):
    packed, ids = rows("p9_containers"), rows("p8_ids")
    size = {i: len(x) for i, x in zip(ids["doc_id"], ids["ids"])}
    assert packed.groupby("doc_id")["n_tokens"].sum().to_dict() == size
    assert packed.groupby("container")["n_tokens"].sum().max() <= 2048
    cut = packed[packed["piece"] > 0]["doc_id"]
    assert all(size[i] > 2048 for i in cut)
    fill = rows("p9_fill").iloc[0]
    assert fill["containers"] == packed["container"].nunique() and fill["tokens"] == packed["n_tokens"].sum()


def test_sentences_cover_every_text(rows, spark):
    found = rows("p10_found").sort_values(["doc_id", "inicio"])
    by = {d: list(zip(g["inicio"], g["fim"])) for d, g in found.groupby("doc_id")}
    for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect():
        text, at = r["text"] or "", 0
        for a, b in by.get(r["doc_id"], []):
            assert not text[at:a].strip() and text[a:b] == text[a:b].strip() != ""
            at = b
        assert not text[at:].strip()


def test_truth_agrees_where_all_observations_do(rows):
    truth = rows("p2_truth")
    assert not truth.duplicated(["fonte", "id_fonte", "campo"]).any() and truth["confianca"].between(0, 1).all()
    agreement = rows("p2_agreement").set_index("campo")
    assert set(agreement.index) == {"telefone", "rating", "reviews", "endereco"} and (agreement["iguais"] <= agreement["itens"]).all() and (agreement["iguais"] > 0).all()


def test_extra_columns_and_clashing_names(spark):
    """Tables with more columns, some named like the operators' own."""
    names = {"p7_found": ["terreiros_all_sources_v2", "revisao_google"], "p3_found": ["terreiros_all_sources_v2", "revisao_humana_nacao_v2"], "p10_found": ["documents"]}
    for query, tables in names.items():
        path = f"/tmp/cartoria-clash-{os.getpid()}-{query}"
        for t in tables:
            spark.read.parquet(f"{DATA}/{t}.parquet").withColumns({c: F.lit("x") for c in ("key", "word", "_h", "value", "words", "n")}).write.mode("overwrite").parquet(f"{path}/{t}.parquet")
        assert QUERIES[query](spark, path).count() == QUERIES[query](spark, DATA).count()
