"""Formatting copies, look-alikes, tokens, packing and sentences, each against brute force or an exact round trip."""

import collections
import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartoria.llm import formatting, lookalikes, packing, sentences, tokens

VOCABULARY = f"{tokens.TOKENIZERS}/byte_bpe_50k.tiktoken"


# problem 7


def key(text):
    return tuple(sorted(w for w in re.split(r"[^\w]|_", (text or "").lower()) if w))


@pytest.mark.parametrize("hot", [1, 3, 10_000])
def test_copies_are_brute_force(spark, hot):
    random.seed(hot)
    words = ["Ilê", "ilê", "AXÉ", "axé", "(axé)", "x1"]
    rows = [(i, " ".join(random.choices(words, k=2)) if i % 9 else None, random.choice(["a", None]), random.choice([1.0, float("nan"), None])) for i in range(120)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "pos long, nome string, fonte string, y double, first string").withColumn("palavras", formatting.words_key(F.col("nome")))
    got = sorted((r["id"], r["first"], r["copies"]) for r in formatting.collapse_copies(df, "pos", ["palavras", "fonte", "y"], hot=hot).collect())
    groups = collections.defaultdict(list)
    for i, n, f, y in rows:
        groups[key(n), f, repr(y)].append(i)
    assert got == sorted((i, min(g), len(g)) for g in groups.values() if len(g) > 1 for i in g)
    assert formatting.collapse_copies(df.limit(0), "pos", ["palavras", "fonte", "y"]).count() == 0


# problem 3


@pytest.mark.parametrize(
    ("stored", "shown"),
    [("Ｔｅｒｒｅｉｒｏ", "Terreiro"), ("Ilê", "Ilê"), ("Ter​reiro", "Terreiro"), ("Casa Velha", "Casa Velha"), ("Tеrreiro", "Terreiro"), ("Angoⅼa", "Angola"), ("𝙸𝚕ê", "Ilê"), ("mına", "mina"), ("Κetu", "Ketu")],
)
def test_repairs(stored, shown):
    repaired, wanted, changed = lookalikes.repair(stored)
    assert lookalikes.substitute(repaired, {shown.lower()}) == shown and (changed or wanted == [shown.lower()])


@pytest.mark.parametrize("text", ["Terreiro\tA\nB", "Ẹgbẹ́ Ilé", "“Ilê” – Axé’s", "Ilê (Храм)", "Casa (بيت)", "Casa (テレイロ)", "Casa (ΣΠΊΤΙ)", "F0BEKADE", "", "Àṣẹ Ọ̀kan"])
def test_ordinary_text_stays(text):
    repaired, _, changed = lookalikes.repair(text)
    assert (repaired, changed) == (text, False)


def test_repaired_rows(spark):
    rows = [(1, "Casa de Santo"), (2, "Casa ԁе Santo"), (3, "Casa (ХРАМ)"), (4, None), (5, ""), (6, "Ｃａｓａ"), (7, "Casa ԁе Ｓａｎｔｏ")]
    df = spark.createDataFrame([(*r, "z", True) for r in rows], "pos long, t string, word string, sure boolean").select("pos", "t")
    got = {r["pos"]: r["repaired"] for r in lookalikes.repaired_texts(df, ["pos"], "t").collect()}
    assert got == {2: "Casa de Santo", 6: "Casa", 7: "Casa de Santo"}
    assert lookalikes.repaired_texts(df.limit(0), ["pos"], "t").count() == 0


# problem 8

SAMPLES = ["", "a", "hello world", "<|endoftext|> x", "Ilê Axé  Ọ̀kan\r\n\r\n", "誰が鍵を持っていますか？", "ทีมสำรวจ", "👩🏾‍🦱" * 40, "x" * 5000, "ab" * 700 + "é" * 900, " \t \n ", "don't I'll 12345 6.78", "\u0000�"]


def test_encoding_is_that_of_the_public_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = tokens.load_ranks(VOCABULARY)
    public = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(i, t) for i, t in enumerate(SAMPLES)] + [(99, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in tokens.encode(df, "doc_id", "text", VOCABULARY).collect()}
    assert got == {i: public.encode_ordinary(t) if t else [] for i, t in rows}
    counts = {r["doc_id"]: r["n_tokens"] for r in tokens.encode(df, "doc_id", "text", VOCABULARY, counts_only=True).collect()}
    assert counts == {i: len(ids) for i, ids in got.items()}
    assert tokens.encode(df.limit(0), "doc_id", "text", VOCABULARY).count() == 0


def test_decoding_gives_the_text_back():
    ranks = tokens.load_ranks(VOCABULARY)
    back = {v: k for k, v in ranks.items()}
    encoder = tokens.Encoder(VOCABULARY)
    for text in SAMPLES:
        assert b"".join(back[i] for i in encoder.encode(text)).decode() == text


def test_long_and_short_words_merge_alike():
    random.seed(1)
    ranks = tokens.load_ranks(VOCABULARY)
    for _ in range(200):
        word = bytes(random.choices(b"abcdeth \xc3\xa9", k=random.randint(1, 60)))
        assert tokens.merge_short(word, ranks) == tokens.merge_long(word, ranks)


# problem 9


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_bins_keep_every_constraint(score):
    rng = np.random.default_rng(5)
    items = np.column_stack([rng.integers(0, 101, 400), np.ones(400), rng.integers(0, 50, 400)]).astype(float)
    capacity = np.array([100.0, 6.0, 60.0])
    placed = packing.vector_best_fit(items, capacity, np.array([1.0, 0.1, 0.1]), score)
    for b in np.unique(placed):
        assert (items[placed == b].sum(axis=0) <= capacity + 1e-9).all()
    assert len(np.unique(placed)) <= 1.25 * max((items.sum(axis=0) / capacity).max(), 1) + 2


def test_packing_loses_nothing(spark):
    sizes = [0, None, 1, 2048, 2049, 4096, 5000, 700, 700, 648, *range(1, 300, 7)]
    df = spark.createDataFrame([(i, n, "x") for i, n in enumerate(sizes)], "doc_id long, n long, piece string")
    rows = packing.pack(df, "doc_id", "n", group_tokens=6_000).collect()
    total = collections.Counter()
    for r in rows:
        total[r["container"]] += r["n"]
    assert max(total.values()) <= 2048
    for i, n in enumerate(sizes):
        own = sorted((r["piece"], r["start"], r["n"]) for r in rows if r["doc_id"] == i)
        assert sum(x[2] for x in own) == (n or 0)
        assert [x[1] for x in own] == [2048 * k for k in range(len(own))]
        assert len(own) == max(1, -(-(n or 0) // 2048))
    assert packing.pack(df.limit(0), "doc_id", "n").count() == 0


def test_attention_cost_decides(spark):
    """7 + 3 and 6 + 4 fit by tokens and places; by cost (49 + 9, 36 + 16 of 55) only the second do. An item over the cost is alone."""
    sizes = [(1, 7), (2, 3), (3, 6), (4, 4), (5, 8), (6, 2)]
    df = spark.createDataFrame(sizes, "id long, n long")

    def bins(cost):
        packed = packing.pack(df, "id", "n", capacity=10, max_items=3, max_cost=cost).collect()
        return {frozenset(r["id"] for r in packed if r["container"] == c) for c in {r["container"] for r in packed}}

    assert bins(1e9) == {frozenset({1, 2}), frozenset({3, 4}), frozenset({5, 6})}
    assert frozenset({5}) in bins(55.0) and frozenset({3, 4}) in bins(55.0) and frozenset({1, 2}) not in bins(55.0)
    for cost in (20.0, 55.0, 90.0):
        size = dict(sizes)
        assert all(len(b) == 1 or sum(size[i] ** 2 for i in b) <= cost and sum(size[i] for i in b) <= 10 for b in bins(cost))
        assert sorted(i for b in bins(cost) for i in b) == [1, 2, 3, 4, 5, 6]


# problem 10


def pieces(text, lang=None):
    return [text[a:b] for a, b in sentences.sentences(text, lang)]


@pytest.mark.parametrize(
    ("lang", "parts"),
    [
        ("pt", ["O Sr. Silva mora na R. das Flores, nº 3.", "Quem vem?", "A roda dura 2,5 horas, p. ex., à noite."]),
        ("pt", ["“Cheguei cedo. Ninguém estava”, contou o ogã.", "A comunidade (antes chamada de Lua!) reúne 21.610 pessoas.", "Ela esperou... e depois cantou."]),
        ("pt", ["voltarei com certeza!!! ✨", "o dr. Silva me indicou.😊", "recomendo demais."]),
        ("en", ["The feast ends at 6 a.m.", "Dr. Rute came at 4:30 p.m. and stayed.", "“Come back soon!” said the elder.", "She asked, “Is it open today?”", "The U.S. team left."]),
        ("fr", ["Quelle belle nuit !", "« Revenez bientôt ! », dit l’ancienne.", "Qui a fermé la porte ?"]),
        ("hi", ["बुज़ुर्ग ने कहा, “फिर आना।”", "डॉ. Rute कल आए।", "कितनी सुंदर रात है!"]),
        ("ar", ["قالت العجوز: «عودوا قريبا.»", "زار د. Rute الساحة.", "من يحتفظ بالمفتاح؟"]),
        (None, ["The council met.", "A casa fechou."]),
    ],
)
def test_sentences(lang, parts):
    assert pieces(" ".join(parts), lang) == parts
    assert pieces("\n".join(parts), "xx" if lang is None else lang) == parts


@pytest.mark.parametrize(
    ("text", "parts"),
    [
        ("「また来てください。」と長老は言いました。彼女は「休みです」と答えた。市場にある（地図を参照。）。", ["「また来てください。」と長老は言いました。", "彼女は「休みです」と答えた。", "市場にある（地図を参照。）。"]),
        ("她回答说：“今天不开门。”这里有三面鼓，都修好了……但是没有人会打。“请再来！”长老在门口说。", ["她回答说：“今天不开门。”", "这里有三面鼓，都修好了……但是没有人会打。", "“请再来！”长老在门口说。"]),
        ("เด็กๆช่วยกัน งานเริ่มเวลา 11 นาฬิกา\n\nประตูเปิด", ["เด็กๆช่วยกัน", "งานเริ่มเวลา 11 นาฬิกา", "ประตูเปิด"]),
        ("Sem marca\r\n\r\nOutra\n \nFim.Logo", ["Sem marca", "Outra", "Fim.", "Logo"]),
        ("", []), (" \n\t ", []), ("a", ["a"]), ("...", ["..."]), ("(aberto. E", ["(aberto.", "E"]),
    ],
)
def test_scripts_and_edges(text, parts):
    assert pieces(text) == parts


def test_nothing_but_white_space_between(spark):
    random.seed(2)
    alphabet = "Aa. !?。”“()\n\r\t…、é 1,😊ก"
    texts = ["".join(random.choices(alphabet, k=80)) for _ in range(300)]
    df = spark.createDataFrame([(i, t, random.choice(["pt", None, "zz"]), 0) for i, t in enumerate(texts)] + [(900, None, None, 0)], "doc_id long, text string, lang string, inicio int")
    spans = collections.defaultdict(list)
    for r in sentences.split_sentences(df, "doc_id", "text", "lang").collect():
        spans[r["doc_id"]].append((r["inicio"], r["fim"]))
    for i, t in enumerate(texts):
        covered = sorted(spans[i])
        rest, at = "", 0
        for a, b in covered:
            assert a >= at and t[a:b] == t[a:b].strip() != ""
            rest, at = rest + t[at:a], b
        assert (rest + t[at:]).strip() == ""
    assert 900 not in spans
    assert sentences.split_sentences(df.limit(0), "doc_id", "text", "lang").count() == 0


def test_composition_used_in_names_is_stable():
    assert unicodedata.normalize("NFC", "ẹ́") == "ẹ́"


@pytest.mark.parametrize(
    ("lang", "parts"),
    [
        ("en", ["He chose plan B.", "Then he left."]), ("en", ["We tested vitamin C.", "The result was clear."]), ("en", ["We gave the present to Al.", "He smiled."]), ("en", ["It was by J. Smith and John F. Kennedy."]),
        (None, ["O Terr. de Pai Miro fica na Av. Sete.", "Veja p. 3."]), ("en", ["A Dra. Ana mora na R. Nova, p. ex. hoje.", "Ela saiu."]), ("pt", ["Le Dr Paul a noté trois noms, p. ex. celui du voisin.", "Il est parti."]),
    ],
)
def test_tables_follow_the_text_not_the_label(lang, parts):
    text = " ".join(parts)
    assert [text[a:b] for a, b in sentences.sentences(text, lang)] == parts


@pytest.mark.parametrize(("token", "script", "mixed"), [("Tеrreiro", "LATIN", 2), ("Храм", "CYRILLIC", 1), ("Хa", "LATIN", 2), ("Москвa", "CYRILLIC", 2), ("12", "", 0)])
def test_dominant_script(token, script, mixed):
    assert lookalikes.dominant_script(token) == (script, mixed)


@pytest.mark.parametrize("text", ["می\u200cخواهم", "क्\u200dष", "👨\u200d👩\u200d👧", "❤️"])
def test_joiners_that_shape_stay(text):
    assert lookalikes.repair(text) == (text, [], False)


def test_vocabulary_decides_about_mixed_tokens(spark):
    rows = [(1, "casa velha"), (2, "Cаsa Velha"), (3, "Zоxub"), (4, "Ꭺxé"), (5, "axé"), (6, "Ọ̀ṣun Cаsa"), (7, "Mосква"), (8, None), (9, "")]
    df = spark.createDataFrame(rows, "pos long, t string")
    got = {r["pos"]: r["repaired"] for r in lookalikes.repaired_texts(df, ["pos"], "t").collect()}
    assert got == {2: "Casa Velha", 4: "Axé", 6: "Ọ̀ṣun Casa"}
    assert lookalikes.repaired_texts(df.limit(0), ["pos"], "t").count() == 0
