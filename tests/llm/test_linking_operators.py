"""Survivors, addresses, names and houses on small tables with known answers."""

import random

import pytest
from pyspark.sql import functions as F

from cartoria.llm import addresses, survivor
from cartoria.llm.address_parse import Address, parse

# problem 2


@pytest.mark.parametrize(
    ("phone", "usable"),
    [("(70) 90200-6571", True), ("+55 70 0002-5721", True), ("5570900025721", True), ("(00) 1234-5678", False), ("1111111111", False), ("0003-6445", False), ("s/ telefone", False), ("", False), (None, False), ("551234567890123", False)],
)
def test_phones(spark, phone, usable):
    df = spark.createDataFrame([(phone,)], "t string")
    assert df.select(survivor.usable_phone(F.col("t"))).first()[0] is usable


@pytest.mark.parametrize(("text", "usable"), [("Rua A, 1", True), (" N/I ", False), ("?", False), ("SEM ENDEREÇO", False), ("12", False), (None, False), ("", False)])
def test_addresses_that_name_a_street(spark, text, usable):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(survivor.usable_address(F.col("t"))).first()[0] is usable


def test_survivors_are_brute_force(spark):
    random.seed(3)
    rows = [(i, random.choice("abc"), random.choice([None, 1, 2, 3]), random.choice([None, 5, 6])) for i in range(1, 60)] + [(99, "single", 1, 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "pos long, k string, v int, t int, best_base string")
    got = survivor.survivors(df, ["k"], "pos", {"a": (F.lit(True), [F.coalesce("v", F.lit(0)), F.coalesce("t", F.lit(0))]), "b": (F.col("v") > 2, [F.coalesce("t", F.lit(0))]), "c": (F.col("v") > 5, [F.lit(1)])})
    for r in got.collect():
        mine = [x for x in rows if x[1] == r["k"]]
        assert r["a"] == max(mine, key=lambda x: (x[2] or 0, x[3] or 0, -x[0]))[0]
        chosen = [x for x in mine if (x[2] or 0) > 2]
        assert r["b"] == (max(chosen, key=lambda x: (x[3] or 0, -x[0]))[0] if chosen else 0)
        assert r["c"] == 0
    assert got.count() == 3 and survivor.survivors(df.limit(0), ["k"], "pos", {"a": (F.lit(True), [F.lit(1)])}).count() == 0


def test_truth_discovery_learns_whom_to_trust(spark):
    random.seed(8)
    claims = []
    for item in range(120):
        truth = f"v{item}"
        for source, right in (("good", 0.95), ("fair", 0.85), ("bad1", 0.3), ("bad2", 0.3)):
            claims.append((str(item), truth if random.random() < right else f"w{random.randint(0, 1)}", source))
    claims += [("null", None, "good"), (None, "x", "good"), ("one", "z", None), ("tie", "b", None), ("tie", "a", None)]
    df = spark.createDataFrame(claims, "item string, value string, source string")
    best = {r["item"]: r["value"] for r in survivor.truth_discovery(df).collect()}
    plain = 0  # what an unweighted vote gets right, ties to the smaller value as above
    for i in range(120):
        votes = [v for item, v, _ in claims if item == str(i)]
        plain += max(sorted(set(votes)), key=votes.count) == f"v{i}"
    right = sum(best[str(i)] == f"v{i}" for i in range(120))
    assert right >= 0.85 * 120 and right > plain
    assert best["one"] == "z" and best["tie"] == "a" and "null" not in best and None not in best
    assert survivor.truth_discovery(df.limit(0)).count() == 0


# problem 4

SAME = [
    "R. Rabegba Bavudokú, n. 5 - Alto do Xutirá, Vila Tadirá - BA, 00009-066, Brasil", "5, rua Rabegba Bavudoku - ALTO DO XUTIRÁ", "Vila Tadirá/BA - Alto Xutirá - Rua Rabegba Bavudokú, nº 0005", "ALTO DO XUTIRA - VILA TADIRA (RUA RABEGBA BAVUDOKU, N. 5)",
    "Alto do Xutirá, R Prof. Rabegba Bavudokú, número 5 (em frente à escola)", "Rua Rabegba Bavudokú 5 CEP 00009066, fundos", "R. Rabegba Bavudokú , # 5 Alto do Xutirá , Vila Tadirá BA , 00009-066 , Brasil",
]


@pytest.mark.parametrize("text", SAME)
def test_parsing(text):
    a = parse(text)
    assert (a.kind, a.street, a.number) == ("rua", "rabegba bavudoku", "5")
    assert a.district in ("alto xutira", "") and a.town in ("vila tadira", "")


@pytest.mark.parametrize(("text", "number"), [("Rua A B, 27A", "27a"), ("Rua A B, s/n", ""), ("Rua A B sn", ""), ("Rua A B, S/Nº - Vila C", ""), ("Rua A B n17", "17"), ("Av. A B, 42 - A. do C", "42"), ("Rua A B, 10, casa", "10")])
def test_numbers(text, number):
    assert parse(text).number == number


@pytest.mark.parametrize("text", [None, "", "-", "?", "N/I", "NÃO CONSTA", "123", " "])
def test_unknown_addresses(text):
    assert parse(text) == Address()


def test_places(spark):
    rows = [(i, t, None, "Vila Tadirá", "00009-066") for i, t in enumerate(SAME)]
    rows += [
        (20, "Rua Rabegba Bavudkoú, 5", "Alto do Xutirá", "Vila Tadirá", None),  # two letters swapped
        (21, "R. R. Bavudokú, 5", "Alto do Xutirá", "Vila Tadirá", "00009066"),  # an initial
        (22, "Rabegba Bavudokú, 5", "Alto do Xutirá", "Vila Tadirá", "00009066"),  # no kind of street
        (30, "Travessa Rabegba Bavudokú, 6", "Alto do Xutirá", "Vila Tadirá", "00009066"), (31, "Rua Rabegba Bavudokú, 6", "Alto do Xutirá", "Vila Tadirá", "00009066"), (32, "Rabegba Bavudokú, 6", "Alto do Xutirá", "Vila Tadirá", "00009066"),
        (40, "Rua Rabegba Bavudokú, 5A", "Alto do Xutirá", "Vila Tadirá", "00009066"), (41, "Rua Rabegba Bavudokú, 5", "Jardim Longe", "Outra", "00500000"), (50, None, None, None, None), (51, "Rua Rabegba Bavudokú, s/n", "Alto do Xutirá", "Vila Tadirá", None),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "pos long, endereco string, bairro string, municipio string, cep string, area string")
    places = {r["pos"]: r["location"] for r in addresses.address_locations(addresses.parsed_addresses(df, "pos", "endereco", "bairro", "municipio", "cep"), "pos").collect()}
    one = {places[i] for i in [*range(len(SAME)), 20, 21, 22]}
    assert len(one) == 1
    assert len({places[i] for i in (30, 31, 32, 40, 41)} | one) == 6
    assert 50 not in places and 51 not in places
    assert addresses.address_locations(addresses.parsed_addresses(df.limit(0), "pos", "endereco", "bairro", "municipio", "cep"), "pos").count() == 0


@pytest.mark.parametrize(
    ("text", "street", "number", "district", "town"),
    [
        ("Rua 7 de Setembro, 100", "7 setembro", "100", "", ""), ("Av. 2 de Julho, 500 - Barra", "2 julho", "500", "barra", ""), ("Rua da Paz, 10, Centro", "paz", "10", "centro", ""), ("Rua da Paz, 10 - Pituba", "paz", "10", "pituba", ""),
        ("Rua da Paz, 10 - Pituba, Salvador - BA", "paz", "10", "pituba", "salvador"), ("Largo do Pelourinho, 3", "pelourinho", "3", "", ""),
    ],
)
def test_numbers_in_streets_and_short_neighbourhoods(text, street, number, district, town):
    a = parse(text)
    assert (a.street, a.number, a.district, a.town) == (street, number, district, town)


def located(spark, rows):
    df = spark.createDataFrame(rows, "pos long, endereco string, bairro string, municipio string, cep string")
    return {r["pos"]: r["location"] for r in addresses.address_locations(addresses.parsed_addresses(df, "pos", "endereco", "bairro", "municipio", "cep"), "pos").collect()}


def test_areas_and_missing_words(spark):
    places = located(spark, [
        (1, "Rua João Silva, 5", "Centro", "Azul", None), (2, "Rua Pedro Silva, 5", "Centro", "Azul", None), (3, "Rua Silva, 5", "Centro", "Azul", None),  # Silva could be either
        (4, "Rua Maria Souza, 5", "Centro", "Azul", None), (5, "Rua Souza, 5", "Centro", "Azul", None),
        (6, "Rua Ana Lima, 8", "Centro", "Azul", "40001-000"), (7, "Rua Ana Lima, 8", "Centro", "Azul", "40009-000"),  # one of the postcodes is wrong
        (8, "Rua Ana Lima, 8", "Pituba", "Azul", "40100-000"), (9, "Rua da Paz, 3, Centro", None, "Azul", None), (10, "Rua da Paz, 3, Pituba", None, "Azul", None), (11, "Rua da Paz, 3, Azul", "Centro", "Azul", None),
    ])
    assert len({places[1], places[2], places[3]}) == 3 and places[4] == places[5]
    assert places[6] == places[7] != places[8] and places[9] != places[10] and places[9] == places[11]


def test_windows_reach_the_recall_of_all_pairs(spark):
    """Spellings of 60 places with an edit each: at least 0.9 of the pairs that all-pairs comparison within a number would link."""
    random.seed(12)
    word = lambda: "".join(random.choice("bdfgklmnprstv") + random.choice("aeiou") for _ in range(4))
    rows, truth = [], {}
    for p in range(60):
        a, b, n = word(), word(), random.randint(1, 30)
        for _ in range(4):
            x = list(b)
            k = random.randrange(1, len(x) - 1)
            x[k], x[k + 1] = x[k + 1], x[k]
            truth[len(rows)] = p
            rows.append((len(rows), f"{random.choice(['Rua', 'R.'])} {a} {''.join(x)}, {n}", random.choice(["Alto do Xutirá", "A. do Xutira"]), "Azul", None))
    places = located(spark, rows)
    pairs = [(i, j) for i in truth for j in truth if i < j]
    same = [(i, j) for i, j in pairs if truth[i] == truth[j]]
    assert sum(places[i] == places[j] for i, j in same) >= 0.9 * len(same)
    assert sum(places[i] == places[j] for i, j in pairs if truth[i] != truth[j]) <= 0.02 * len(same)
