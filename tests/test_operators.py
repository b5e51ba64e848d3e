"""Operators on small tables: order, nulls, doubles, empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from cartoria.functions.text import first_label
from cartoria.operators.audit import histogram, histogram_map, over_fixed, reconciled
from cartoria.operators.classify import RuleSet, is_place, refine_ambiguous, removal_reason, scan_buckets, with_nation
from cartoria.operators.components import components
from cartoria.operators.decisions import imported, latest_decisions, overlaid_queue, queue_filter, upserted, valid_imports, writable
from cartoria.operators.entities import clusters, linked_pairs, match_pairs, merged_entities
from cartoria.operators.keyed import excluded, first_wins, globally_ranked, last_wins, overlaid, ranked_first, split_by
from cartoria.operators.records import merged_map, narrow_features, normalized_primary, rules_table
from cartoria.operators.skew import blocked_join, hot_keys, sieve_of, sifted


@pytest.mark.parametrize(
    ("raw", "label", "original"),
    [("Keto", "Keto", "Keto"), ("Keto Angola", "Keto Angola", "Keto Angola"), (None, "Não informado", None), ("  ", "Não informado", None), ("sem informação", "Não informado", "sem informação"),
     ("  Nagô   Vodum ", "Nagô Vodum", "Nagô   Vodum"), ("NÃO INFORMADO", "Não informado", "NÃO INFORMADO"), (" Jeje ", "Jeje", "Jeje")],
)
def test_nation(spark, raw, label, original):
    row = with_nation(spark.createDataFrame([(raw, "x")], "nacao string, nome string")).first()
    assert (row["nacao_categoria"], row["nacao_original"], row["nacao_componentes"], row["nacao_primaria"]) == (label, original, [], None)


RULES = RuleSet(protective=["axé"], labelled=[("um", "bar"), ("dois", "bar e")], blocking=["mercad", "mercadinho"], places=["x"])


def test_scan_order(spark):
    names = ["Axé bar", "bar e", "x", "X BA", "y", "", None]
    rows = scan_buckets(spark.createDataFrame([(n,) for n in names], "nome string"), "nome", RULES).collect()
    assert [(r["bucket"], r["razao"]) for r in rows] == [
        ("real", None), ("suspect", "um"), ("suspect", "Nome de município"), ("suspect", "Nome de município"), ("ambiguous", "Sem palavra-chave"), (None, None), (None, None),
    ]


@pytest.mark.parametrize(("text", "chained", "suffixed"), [("x", True, True), ("x ba", True, True), ("x bahia", False, True), ("x-ba", True, True), ("x, bahia", False, True), ("x ba.", False, True), ("xb", False, False)])
def test_places(spark, text, chained, suffixed):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(is_place(F.col("v"), ["x"], True)).first()[0] is chained
    assert df.select(is_place(F.col("v"), ["x"], False)).first()[0] is suffixed


def test_removal(spark):
    df = spark.createDataFrame([("Axé suspeito",), ("axé suspeito",), ("mercadinho",), ("x bahia",), ("z",), (None,)], "nome string")
    gone = spark.createDataFrame([("Axé suspeito",), ("Axé suspeito",), (None,)], "nome string")
    got = {r["nome"]: (r["remover"], r["razao"]) for r in removal_reason(df, "nome", gone, RULES).collect()}
    assert got == {"Axé suspeito": (True, "Suspeito exato"), "axé suspeito": (False, None), "mercadinho": (True, "KW: mercad"), "x bahia": (True, "Nome de município"), "z": (False, None), None: (False, None)}


def test_refine(spark):
    df = spark.createDataFrame([("Axé bar",), ("bar",), ("z",), (None,)], "nome string")
    assert [(r["decisao"], r["razao"]) for r in refine_ambiguous(df, "nome", ["axé"], RULES).collect()] == [("manter", None), ("remover", "um"), ("remover", "Sem palavra-chave"), ("remover", "Sem palavra-chave")]


def test_which_row_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), (None, 3, "n"), (None, 4, "m")], "k string, pos int, v string")
    assert {r["k"]: r["v"] for r in last_wins(df, ["k"], "pos").collect()} == {"a": None, None: "m"}
    assert {r["k"]: r["v"] for r in first_wins(df, ["k"], "pos").collect()} == {"a": "x", None: "n"}
    assert last_wins(df.limit(0), ["k"], "pos").count() == 0


def test_overlay_counts_zero_as_a_value(spark):
    now = spark.createDataFrame([("a", 4.0), ("b", 3.0)], "k string, rating double")
    before = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 0.0), ("b", 1, None)], "k string, o int, rating double")
    assert {r["k"]: r["rating"] for r in overlaid(now, before, ["k"], ["rating"], "o").collect()} == {"a": 0.0, "b": 3.0}


def test_exclusion_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 2.0)], "nome string, lat double")
    ledger = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", None)], "nome string, lat double")
    key = [F.col("nome"), F.col("lat")]
    assert sorted(r["nome"] for r in excluded(df, ledger, key, key).collect()) == ["b", "c"]
    assert excluded(df, None, key, key).count() == 3


def test_sample_and_split(spark):
    df = spark.createDataFrame([("a", i) for i in range(15)] + [(None, 99)], "g string, pos int")
    assert sorted(r["pos"] for r in ranked_first(df, ["g"], [F.col("pos")], 10).collect()) == [*range(10), 99]
    yes, no = split_by(df, F.col("g") == "a")
    assert (yes.count(), no.count()) == (15, 1)


def test_histograms(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), (None, 4)], "k string, pos int")
    counts = histogram(df, F.col("k"), "k", "pos")
    assert {r["k"]: (r["n"], r["first"]) for r in counts.collect()} == {"b": (2, 1), "a": (1, 2), None: (1, 4)}
    assert histogram_map(counts, "k").first()[0] == {"": 1, "a": 1, "b": 2}
    assert [(r["k"], r["n"]) for r in over_fixed(counts, "k", ["a", "z"], ["n"]).orderBy("ord").collect()] == [("a", 1), ("z", 0)]


def test_decisions(spark):
    log = spark.createDataFrame([("1", "manter", "", "t1"), ("1", "falso_positivo", "m", "t2"), ("1", "falso_positivo", "m", "t2"), (None, "manter", "", "t3"), ("2", "falso_positivo", " ", "t1"), ("3", "outra", "", "t1")], "id string, status_revisao string, motivo_decisao string, t string")
    latest = latest_decisions(log, "id", [F.col("t")])
    assert {r["id"]: r["status_revisao"] for r in latest.collect()} == {"1": "falso_positivo", "2": "falso_positivo", "3": "outra"}
    known = spark.createDataFrame([("1",), ("2",)], "id string")
    valid = valid_imports(log, known, "id").collect()
    assert sorted((r["id"], r["status_revisao"], r["motivo_decisao"]) for r in valid) == [("1", "falso_positivo", "m"), ("1", "falso_positivo", "m"), ("1", "manter", ""), ("2", "falso_positivo", " ")]
    written = writable(log, "status_revisao").filter(F.col("id").isNotNull()).collect()
    assert sorted((r["id"], r["status_revisao"], r["motivo_decisao"]) for r in written) == [("1", "falso_positivo", "m"), ("1", "falso_positivo", "m"), ("1", "manter", "")]
    store = imported(log.limit(0).withColumn("observacoes", F.lit("")), log.withColumn("observacoes", F.lit(None).cast("string")), known, "id", "t").collect()
    assert {r["id"]: (r["status_revisao"], r["observacoes"], r["origem"]) for r in store} == {"1": ("falso_positivo", "", "CSV importado"), "2": ("falso_positivo", "", "CSV importado")}
    queue = spark.createDataFrame([("1", "pendente"), ("9", "pendente")], "id string, status_revisao string")
    assert {r["id"]: (r["status_revisao"], r["decidido"]) for r in overlaid_queue(queue, latest, "id", ["status_revisao"]).collect()} == {"1": ("falso_positivo", True), "9": ("pendente", False)}
    newer = spark.createDataFrame([("1", "manter", "", "t2")], log.schema)
    assert {r["id"]: r["status_revisao"] for r in upserted(latest, newer, "id", "t").collect()}["1"] == "manter"


def test_queue_filter(spark):
    q = spark.createDataFrame([("Ilê", "RUA a", None, "pendente", "x"), (None, None, None, "manter", "y")], "nome string, endereco string, bairro string, status_revisao string, sugestao string")
    assert queue_filter(q, " rua ").count() == 1 and queue_filter(q).count() == 2 and queue_filter(q, status="manter", suggestion="y").count() == 1


def test_entities(spark):
    rows = [(1, "ceao", "Ilê Axé Um", -10.0, -40.0, None), (2, "google", "Outro", -10.0001, -40.0, "rua"), (3, "osm", "ILE AXE UM", None, None, ""), (4, "osm", "Só", -12.0, -40.0, "z"), (5, "ceao", None, float("nan"), -40.0, None)]
    df = spark.createDataFrame(rows, "pos long, fonte string, nome string, lat double, lng double, endereco string")
    pairs = match_pairs(df)
    assert sorted((r["a"], r["b"], r["regra"]) for r in pairs.collect()) == [(1, 2, "distancia"), (1, 3, "nome")]
    labels = clusters(linked_pairs(df))
    assert {r["pos"]: r["grupo"] for r in labels.collect()} == {1: 1, 2: 1, 3: 1}
    merged = {r["grupo"]: (r["registros"], r["endereco"]) for r in merged_entities(df, labels, ["nome", "endereco"]).collect()}
    assert merged == {1: (3, "rua"), 4: (1, "z"), 5: (1, None)}


def brute_groups(rows, tied):
    """Groups of the rows ``(pos, fonte, name)`` of different sources whose names are ``tied``, by smallest pos."""
    label = {r[0]: r[0] for r in rows}
    for _ in rows:
        for p, f, n in rows:
            for q, g, m in rows:
                if (f or None) != (g or None) and n and m and tied(n, m):
                    label[p] = label[q] = min(label[p], label[q])
    return {p: x for p, x in label.items() if sum(y == x for y in label.values()) > 1}


def test_links_join_all_rows_of_a_name(spark):
    schema = "pos long, fonte string, nome string, lat double, lng double"
    at = lambda rows: spark.createDataFrame([(*r, None, None) for r in rows], schema)
    rows = [(1, "google", "Ilê Axé Um"), (2, "google", "ILE AXE UM"), (3, "ceao", "Ile-Axe Um"), (4, "osm", "Oxum"), (5, None, "OXUM"), (6, "", "oxum"), (7, "osm", "Outra casa"), (8, "osm", "outra casa"), (9, None, None), (10, "ceao", "")]
    links = linked_pairs(at(rows))
    assert {r["pos"]: r["grupo"] for r in clusters(links).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4}
    assert {r["regra"] for r in links.collect()} == {"nome"} and links.count() < len(rows)
    rng = random.Random(5)
    many = [(i, rng.choice(["ceao", "google", "osm", None, ""]), rng.choice(["b", "dd", "fff", "gggg", "hh jj"])) for i in range(14)]
    assert {r["pos"]: r["grupo"] for r in clusters(linked_pairs(at(many))).collect()} == brute_groups(many, lambda n, m: n == m)
    assert linked_pairs(at(rows).limit(0)).count() == 0


def test_links_join_names_that_hold_others(spark):
    schema = "pos long, fonte string, nome string, lat double, lng double"
    at = lambda rows: spark.createDataFrame([(*r, None, None) for r in rows], schema)
    rows = [(1, "google", "Ilê Axé X"), (2, "ceao", "ILE AXE X (Umbanda)"), (3, "osm", "Rosas"), (4, "ceao", "Casa Rosas"), (5, "osm", "Abcdef"), (6, "osm", "Abcdef g"), (7, None, "xabcdefx")]
    links = linked_pairs(at(rows))
    assert {(r["a"], r["b"], r["regra"]) for r in links.collect()} == {(1, 2, "inclusao"), (5, 7, "inclusao")}
    rng = random.Random(9)
    for _ in range(3):
        many = [(i, rng.choice(["ceao", "google", None]), " ".join(rng.choice(["abc", "defg", "hijkl", "mno", "pqrs"]) for _ in range(rng.randint(1, 3)))) for i in range(26)]
        tied = lambda n, m: n == m or (min(len(n), len(m)) > 5 and (n in m or m in n))
        assert {r["pos"]: r["grupo"] for r in clusters(linked_pairs(at(many))).collect()} == brute_groups(many, tied)


def test_ranks_over_ranges(spark):
    rows = [(i * 7919 % 500, i) for i in range(400)] + [(None, 400)]
    df = spark.createDataFrame(rows, "v long, pos long").repartition(5)
    got = {r["pos"]: r["rank"] for r in globally_ranked(df, [F.col("v"), F.col("pos")]).collect()}
    want = {pos: n for n, (_, pos) in enumerate(sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1])), 1)}
    assert got == want and globally_ranked(df.limit(0), [F.col("v")]).count() == 0


def test_hot_keys_are_split(spark):
    left = spark.createDataFrame([(i % 3 if i < 90 else 7, i) for i in range(120)] + [(None, 999)], "k long, v long")
    right = spark.createDataFrame([(k, f"w{k}{j}") for k in range(9) for j in range(3)], "k long, w string")
    assert hot_keys(left, ["k"], 100) is None
    assert {r["k"]: r["count"] for r in hot_keys(left, ["k"], 29).collect()} == {0: 30, 1: 30, 2: 30, 7: 30}
    plain = sorted(map(tuple, left.join(right, "k").collect()))
    for block in (5, 29, 1_000):
        assert sorted(map(tuple, blocked_join(left, right, ["k"], block).select("k", "v", "w").collect())) == plain


def test_components(spark):
    random.seed(6)
    edges = [(i, i + 1) for i in range(40)] + [(random.randint(100, 160), random.randint(100, 160)) for _ in range(30)] + [(7, 7), (None, 3)]
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges[:-1]:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df, "a", "b").collect()}
    assert got == {x: find(x) for a, b in edges[:-1] if a != b for x in (a, b)}
    assert components(df.limit(0), "a", "b").count() == 0


def test_primary_records(spark):
    df = spark.createDataFrame([(1, 7, "<html>", -12.0, -38.0, "old"), (2, None, "<html>", 0.0, 0.0, "old")], "pos int, id int, raw_html string, lat double, lng double, fonte string")
    rows = normalized_primary(df, "ceao", "CEAO").orderBy("pos").collect()
    assert "raw_html" not in rows[0].asDict() and "id" not in rows[0].asDict()
    assert [(r["ceao_id"], r["fonte"], r["geo_status"], r["fontes"][0]["id"]) for r in rows] == [("7", "ceao", "in_bahia", "7"), ("", "ceao", "out_of_bahia", "")]


def test_aliases_stop_at_a_key_that_is_there(spark):
    df = spark.sql("SELECT 1 pos, map('lat', '-12', 'lng', '-38', 'name', 'a') f UNION ALL SELECT 2, map('lat', '-12', 'lng', '-38', 'nome', CAST(NULL AS STRING), 'name', 'b') UNION ALL SELECT 3, map('lat', 'x', 'lng', '-38') UNION ALL SELECT 4, map('lat', '-12', 'lng', '-38', 'cidade', 'c')")
    got = {r["pos"]: (r["nome"], r["municipio"]) for r in narrow_features(df, "f").collect()}
    assert got == {1: ("a", ""), 2: (None, ""), 4: ("", "c")}


def test_maps_merge(spark):
    row = spark.sql("SELECT map('a', '1', 'b', '2') o, map('b', '3') n, CAST(NULL AS MAP<STRING, STRING>) z").select(merged_map(F.col("o"), F.col("n")).alias("m"), merged_map(F.col("z"), F.col("n")).alias("k")).first()
    assert row["m"] == {"a": "1", "b": "3"} and row["k"] == {"b": "3"}


def test_hundreds_of_rules_keep_their_order(spark):
    rules = [("x", i, f"r{i}", f"w{i:03d}") for i in range(400)] + [("y", 0, "other", ".")]
    table = spark.createDataFrame(rules, "kind string, ord int, label string, pattern string").repartition(7)
    read = rules_table(table, "x")
    assert [label for label, _ in read] == [f"r{i}" for i in range(400)]
    got = spark.createDataFrame([("a w399 w007",), ("nothing",), (None,)], "t string").select(first_label(F.col("t"), read).alias("l")).collect()
    assert [r["l"] for r in got] == ["r7", None, None]


def test_reconciliation(spark):
    now = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    before = spark.createDataFrame([("b",), ("c",), ("c",), (None,)], "id string")
    row = reconciled(now, before, "id").first()
    assert (row["extraidos"], row["ids_unicos"], row["presentes_na_v1"], row["adicionados_na_v2"], row["ausentes"]) == (4, 2, 2, 1, 1)
    assert reconciled(now.limit(0), before.limit(0), "id").first()["extraidos"] == 0


def test_links_by_points_are_those_of_all_pairs(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["ceao", "google", "osm", None]), None, -10.0 - 0.0003 * rng.randint(0, 9), -40.0) for i in range(40)]
    df = spark.createDataFrame(rows, "pos long, fonte string, nome string, lat double, lng double")
    label = {r[0]: r[0] for r in rows}
    for _ in rows:
        for p, f, _n, y, _x in rows:
            for q, g, _m, z, _w in rows:
                if f != g and abs(y - z) * 111_194.9 <= 50:
                    label[p] = label[q] = min(label[p], label[q])
    want = {p: x for p, x in label.items() if sum(v == x for v in label.values()) > 1}
    links = linked_pairs(df)
    assert {r["pos"]: r["grupo"] for r in clusters(links).collect()} == want and links.count() < 4 * len(rows)


def test_a_sieve_lets_all_sought_through(spark):
    sought = spark.range(50).select((F.col("id") * 7 - 100).alias("value"))
    df = spark.range(-2000, 2000).select(F.col("id").alias("v"), F.lit("x").alias("t")).union(spark.sql("SELECT CAST(NULL AS BIGINT), 'n'"))
    got = {r["v"] for r in sifted(df, "v", sieve_of(sought)).collect()}
    assert got == {i * 7 - 100 for i in range(50)}
    assert sifted(df, "v", sieve_of(sought.limit(0))).count() == 0
