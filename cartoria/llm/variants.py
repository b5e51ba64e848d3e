"""Problem 6: variant spellings of names typed by people.

MinHash banding over padded q-grams of the own words, as they were typed, verified by Monge-Elkan similarity, clustered into stars.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartoria.functions.lineage import cut, only
from cartoria.llm.houses import keyed_records, readings, source_units
from cartoria.llm.linkage import measured
from cartoria.operators.skew import blocked_join, passing, sieve_of, small, unique

RECALL, SIMILARITY, HASHES, LEAST = 0.99, 0.62, 116, 0.82
#: So many seekers that share a value are compared in one block.
BLOCK = 1_000
#: So many bands are sought at once, so that the disk holds the shuffle of a part of them.
PASS = 10
#: Kinds of shared values: a MinHash band of a town, a whole word and an end of another, the other words and an initial of a town.
BAND, ENDS, INITIAL = 0, 1, 2


def collision(similarity: float, rows: int, bands: int) -> float:
    """The chance that two sets of this similarity share at least one band."""
    return 1 - (1 - similarity**rows) ** bands


def tuned_bands(recall: float = RECALL, similarity: float = SIMILARITY, hashes: int = HASHES) -> tuple[int, int]:
    """(rows, bands): the most rows a band may have while the collision curve still reaches the recall at the similarity."""
    fitting = [(rows, hashes // rows) for rows in range(1, hashes + 1) if collision(similarity, rows, hashes // rows) >= recall]
    if not fitting:
        raise ValueError("more hashes are needed for this recall")
    return fitting[-1]


@lru_cache(maxsize=1 << 15)
def gram_hashes(gram: str, hashes: int) -> np.ndarray:
    """The values of all hash functions for one q-gram: fixed for a gram, whoever computes it."""
    seed = int.from_bytes(gram.encode()[:16].ljust(16, b"\0"), "little")
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**32, hashes, dtype=np.uint32)


@lru_cache(maxsize=1 << 15)
def word_minima(word: str, hashes: int) -> np.ndarray:
    """The smallest value of each hash function over a word's q-grams; kept, as words repeat and every pass over the bands asks again."""
    return np.minimum.reduce([gram_hashes(g, hashes) for g in padded_grams(word)])


def padded_grams(words: str, q: int = 3) -> set[str]:
    """The q-grams of each word with q - 1 marks before its first and after its last letter."""
    return {padded[i : i + q] for w in words.split() for padded in ["^" * (q - 1) + w + "$" * (q - 1)] for i in range(len(padded) - q + 1)}


def band_values(words: list[str], towns: np.ndarray, rows: int, bands: int, part: slice = slice(None)) -> np.ndarray:
    """(names, bands): hashes of the bands, or a ``part`` of them, of each name's MinHash signature in its town."""
    mix = (np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, (bands, rows), dtype=np.uint64) | np.uint64(1))[part]
    which = np.arange(bands, dtype=np.uint64)[part]
    split = [w.split() for w in words]
    each = {w: i for i, w in enumerate(dict.fromkeys(w for ws in split for w in ws))}  # a name's minimum is that of its words, of which many repeat
    starts = np.concatenate(([0], np.cumsum([len(ws) for ws in split])[:-1])).astype(np.int64)
    by_word = np.stack([word_minima(w, rows * bands) for w in each]).reshape(len(each), bands, rows)[:, part].reshape(len(each), -1)
    signature = np.minimum.reduceat(by_word[[each[w] for ws in split for w in ws]], starts, axis=0).astype(np.uint64).reshape(len(words), len(which), rows)
    with np.errstate(over="ignore"):
        folded = (signature * mix).sum(axis=2, dtype=np.uint64)
        folded ^= folded >> np.uint64(29)
        return (folded * np.uint64(0x9E3779B97F4A7C15) + which + towns.view(np.uint64)[:, None]).view(np.int64)


def end_values(words: str) -> list[str]:
    """What two names that differ by one error share: a whole word and an end of another one, or an end of an only word; and all letters."""
    ws = words.split()
    letters = "*" + "".join(sorted(words.replace(" ", "")))
    if len(ws) == 1:
        return [letters, "<" + words[:3], ">" + words[-3:]]
    return [letters, *[f"{a} {end}" for i, a in enumerate(ws) for j, b in enumerate(ws) if i != j for end in ("<" + b[:2], ">" + b[-2:])]]


def initial_values(words: str, offered: bool) -> list[str]:
    """The other words and an initial: of the words that are initials, or, ``offered``, of each word of a name without initials."""
    ws = words.split()
    return [" ".join([*ws[:i], *ws[i + 1 :]]) + "=" + w[0] for i, w in enumerate(ws) if len(ws) > 1 and (offered or len(w) == 1)]


def name_values(names: DataFrame, offered: bool, sieve=None, banded: bool = True, part: slice = slice(None)) -> DataFrame:  # noqa: ANN001 - a broadcast of bytes
    """``key, kind, value, common``: what readings can share.

    Sought are bands by uncommon readings, beside them the ends and letters of names of one word, ends by readings without a town, initials by readings that have some. Offered are bands by all
    and the others by readings that have a town and no initial. A ``sieve`` leaves out values that nobody seeks.
    Without ``banded`` there are no bands. With a ``part`` there are only these bands; all else comes with the part that has the first one.
    """
    rows, bands = tuned_bands()
    wanted = len(range(bands)[part])
    first = not part.start
    hashed = lambda texts, seed: [xxhash.xxh64_intdigest(t, seed) for t in texts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None if sieve is None else np.frombuffer(sieve.value, dtype=np.uint8)
        for whole in batches:
            for at in range(0, whole.num_rows, 4_000):
                batch = whole.slice(at, 4_000)
                key, town = batch.column(0).to_numpy(), batch.column(2).to_numpy()
                words = batch.column(1).to_pylist()
                townless, common, initial = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 4, 5))
                parts = []
                who = np.arange(len(words)) if offered else np.flatnonzero(~common)
                if banded and len(who):
                    parts.append((np.repeat(who, wanted), BAND, band_values([words[i] for i in who], town[who], rows, bands, part).reshape(-1)))
                single = np.array([i for i in who if " " not in words[i]], dtype=np.int64) if banded and first else who[:0]  # one error takes much of a short name's q-grams
                for kind, who, texts in (
                    (BAND, single, end_values),
                    (ENDS, np.flatnonzero(~initial & (~townless if offered else townless)), end_values),
                    (INITIAL, np.flatnonzero(~townless & (~initial if offered else initial)), lambda w: initial_values(w, offered)),
                ) if first else ():
                    made = [hashed(texts(words[i]), int(town[i]) & 0xFFFFFFFF if kind != ENDS else 0) for i in who]
                    parts.append((np.repeat(who, [len(m) for m in made]), kind, np.array([v for m in made for v in m], dtype=np.uint64).view(np.int64)))
                if not parts:
                    continue
                index, kinds, values = np.concatenate([p[0] for p in parts]), np.concatenate([np.full(len(p[0]), p[1], np.int8) for p in parts]), np.concatenate([p[2] for p in parts])
                if kept is not None:
                    met = passing(values, kept)
                    index, kinds, values = index[met], kinds[met], values[met]
                yield pa.RecordBatch.from_arrays([pa.array(key[index]), pa.array(kinds), pa.array(values), pa.array(common[index])], ["key", "kind", "value", "common"])

    told = names.filter(F.col("words") != "").select("key", "words", F.xxhash64("town").alias("t"), (F.col("town") == "").alias("townless"), "common", "initial")
    return told.mapInArrow(run, "key bigint, kind byte, value bigint, common boolean")


def name_candidates(names: DataFrame, block: int = BLOCK, bands: bool = True) -> DataFrame:
    """``own, key, kind``, written: every pair of a seeker ``own`` and another reading that offers a value it seeks.

    Two seekers of one band are a pair once, the smaller ``own`` first.

    All members of a MinHash bucket meet all its seekers. A value with more than ``block`` seekers is split into blocks.
    Without ``bands`` only readings without a town or with an initial seek. Bands are sought ``PASS`` at once; a pair that several passes find is one.
    """
    spark = names.sparkSession
    parts = [slice(at, at + PASS) for at in range(0, tuned_bands()[1], PASS)] if bands else [slice(None)]
    if len(parts) == 1:
        return only(spark, lambda: candidates_by(names, block, bands, parts[0]))

    def passes() -> DataFrame:
        found = [only(spark, lambda part=part: candidates_by(names, block, bands, part)) for part in parts]
        return reduce(DataFrame.unionByName, found).distinct()

    return only(spark, passes)


def candidates_by(names: DataFrame, block: int, bands: bool, part: slice) -> DataFrame:
    """The pairs of ``name_candidates`` that share a value of this ``part``."""
    sought = cut(name_values(names, offered=False, banded=bands, part=part))
    sieve = sieve_of(sought)
    offered = name_values(names, offered=True, sieve=sieve, banded=bands, part=part)
    mine = sought.select("value", F.col("kind").alias("_kind"), F.col("key").alias("own"))
    met = blocked_join(unique(mine), offered, ["value"], block)  # a value is salted by its kind
    own, key = F.col("own"), F.col("key")
    one = met.filter((F.col("kind") == F.col("_kind")) & (own != key) & ((F.col("kind") != BAND) | (own < key) | F.col("common")))
    found = cut(one.select("own", "key", "kind").distinct())
    sieve.destroy()  # what was found is written
    return found


def similar_names(pairs: DataFrame, names: DataFrame, least: float, sides: tuple[str, ...] = (), kept: Column | None = None) -> DataFrame:
    """``own, key, s`` of the pairs whose names are similar enough; two names of common words are two names.

    ``sides`` are further columns of ``names``, given as ``a_`` for ``own`` and ``b_`` for ``key``; of the pairs only those that are ``kept`` are measured.
    """
    mine = names.select(F.col("key").alias("own"), F.col("words").alias("w"), F.col("common").alias("c"), *[F.col(x).alias(f"a_{x}") for x in sides])
    its = names.select("key", F.col("words").alias("v"), F.col("common").alias("d"), *[F.col(x).alias(f"b_{x}") for x in sides])
    both = pairs.join(mine, "own").join(its, "key").filter(~(F.col("c") & F.col("d")) | (F.col("w") == F.col("v")))
    both = both if kept is None else both.filter(kept)
    told = ["own", "key", *[f"{e}_{x}" for e in "ab" for x in sides]]
    return measured(both.select(*told, "w", "v"), least).select(*told, "s")


def unit_edges(similar: DataFrame) -> DataFrame:
    """``key, other, similarity, n, n2``: the best pair of readings between two units, with both units' supports; ``similar`` has ``unit`` and ``n`` of both sides."""
    u, v, first = F.col("a_unit"), F.col("b_unit"), F.col("a_unit") < F.col("b_unit")
    side = lambda x, y: F.first(F.when(first, F.col(x)).otherwise(F.col(y)))
    return similar.filter(u != v).groupBy(F.least(u, v).alias("key"), F.greatest(u, v).alias("other")).agg(F.max("s").alias("similarity"), side("a_n", "b_n").alias("n"), side("b_n", "a_n").alias("n2"))


def star_clusters(edges: DataFrame) -> DataFrame:
    """``key, center`` for every node with an edge: stars around the best supported ones.

    ``edges`` has ``key, other, similarity, n, n2`` with the supports of both ends. Nodes rank by support, then by edges, then key. One without an
    undecided neighbour of higher rank becomes a center unless it already touches one; then it is a satellite of
    the most similar center it touches. Each round decides at least the highest open rank of every component, so the rounds end.
    """
    both = edges.select("key", "other", "similarity", "n", "n2").unionByName(edges.select(F.col("other").alias("key"), F.col("key").alias("other"), "similarity", F.col("n2").alias("n"), F.col("n").alias("n2")))
    degree = cut(both.groupBy("key").agg(F.count("*").alias("d")))
    rank = lambda n, d, k: F.struct(F.col(n).alias("n"), F.col(d).alias("d"), (-F.col(k)).alias("k"))
    ranked = both.join(degree, "key").join(degree.select(F.col("key").alias("other"), F.col("d").alias("d2")), "other")
    sided = cut(ranked.select("key", "other", "similarity", rank("n", "d", "key").alias("own"), rank("n2", "d2", "other").alias("its")))
    state = cut(sided.groupBy("key").agg(F.max((F.col("its") > F.col("own")).cast("int")).alias("below")).select("key", F.when(F.col("below") == 0, 1).otherwise(0).alias("is")))  # 1 center, 2 satellite, 0 open
    while state.filter(F.col("is") == 0).limit(1).count():
        around = sided.join(state.select(F.col("key").alias("other"), F.col("is").alias("its_state")), "other").filter(F.col("its") > F.col("own"))
        told = around.groupBy("key").agg(F.max((F.col("its_state") == 1).cast("int")).alias("touch"), F.max((F.col("its_state") == 0).cast("int")).alias("wait"))
        state = cut(
            state.join(told, "key", "left").select("key", F.when(F.col("is") != 0, F.col("is")).when(F.coalesce("touch", F.lit(0)) == 1, 2).when(F.coalesce("wait", F.lit(0)) == 0, 1).otherwise(0).alias("is"))
        )
    centers = state.filter(F.col("is") == 1).select(F.col("key").alias("other"))
    satellites = (
        sided.join(centers, "other").join(state.filter(F.col("is") == 2).select("key"), "key").groupBy("key").agg(F.max(F.struct("similarity", "its", "other")).alias("m")).select("key", F.col("m.other").alias("center"))
    )
    return satellites.unionByName(centers.select(F.col("other").alias("key"), F.col("other").alias("center")))


def settled_houses(housed: DataFrame, candidates: DataFrame, least: float = 0.85, sides: tuple[str, ...] = ()) -> DataFrame:
    """``hash, house, s``, and the columns ``sides``: the houses of all readings after those without a town, or with an initial, joined the one house that they can mean.

    ``housed`` has the readings with their ``house``, ``candidates`` comes from ``name_candidates``. A house is meant if a name of it is at least ``least``
    similar, or has a word for the initial and else the same words. Houses in the named neighbourhood come first, then
    closer names. Where two remain, or readings of one house disagree, nothing is joined. ``s`` is that similarity, 1 where nothing was joined.
    """
    housed = cut(housed.select("key", "hash", "house", "town", "words", "district", "common", "initial", *sides))
    settled = (F.col("town") != "") & ~F.col("initial")
    bound = housed.filter(settled).select("house").distinct()
    loose = housed.filter(~settled & (F.col("words") != "")).join(bound, "house", "left_anti").select("key", "house", "district")
    pairs = candidates.filter(F.col("kind") != BAND).join(loose.select(F.col("key").alias("own")), "own", "left_semi")
    ends = similar_names(pairs.filter(F.col("kind") == ENDS), housed, least)
    found = ends.unionByName(pairs.filter(F.col("kind") == INITIAL).select("own", "key", F.lit(1.0).alias("s")))
    meant = cut(found.join(housed.select("key", F.col("house").alias("center")), "key").groupBy("own", "center").agg(F.max("s").alias("s")).join(loose.select(F.col("key").alias("own"), "house", "district"), "own"))
    here = housed.filter(settled & F.col("district").isNotNull()).select(F.col("house").alias("center"), "district").distinct().join(meant.select("center").distinct(), "center", "left_semi").withColumn("here", F.lit(1))
    ranked = meant.join(here, ["center", "district"], "left").select("own", "house", "center", F.struct(F.coalesce("here", F.lit(0)).alias("near"), "s").alias("r"))
    best = ranked.groupBy("own").agg(F.max("r").alias("r"))
    single = ranked.join(best, ["own", "r"]).groupBy("own", "house").agg(F.count("*").alias("n"), F.min("center").alias("center"), F.max("r.s").alias("s"))
    agreed = single.groupBy("house").agg(F.max("n").alias("n"), F.min("center").alias("center"), F.max("center").alias("also"), F.min("s").alias("s")).filter((F.col("n") == 1) & (F.col("center") == F.col("also")))
    agreed = cut(agreed.select("house", "center", "s"))
    return housed.select("hash", "house", *sides).join(small(agreed), "house", "left").select("hash", F.coalesce("center", "house").alias("house"), F.coalesce("s", F.lit(1.0)).alias("s"), *sides)


def name_clusters(records: DataFrame, least: float = LEAST) -> DataFrame:
    """``key, house`` for the key of every record; ``records`` has ``key, source, words, town, district``.

    Readings that one source id carries are one unit. Uncommon readings meet all of their town's readings in their MinHash buckets; what
    Monge-Elkan finds similar enough links units, and stars of units are houses. Readings without a town or with an initial join the one house that they can mean.
    """
    spark = records.sparkSession
    names = only(spark, lambda: readings(records))
    candidates = name_candidates(names)
    named = only(spark, lambda: source_units(records, names))
    edges = cut(unit_edges(similar_names(candidates.filter(F.col("kind") == BAND), named, least, ("unit", "n"))))
    stars = only(spark, lambda: star_clusters(edges)).select(F.col("key").alias("unit"), "center")
    return settled_houses(named.join(unique(stars), "unit", "left").withColumn("house", F.coalesce("center", "unit")), candidates).select(F.col("hash").alias("key"), "house")


def p6_found(spark: SparkSession, directory: str) -> DataFrame:
    """Pairs of rows of one house, at least one of them sefaz, whose names are different strings."""
    records = keyed_records(spark, directory, {"nome_hash": F.xxhash64("nome")})
    housed = cut(records.select("pos", "fonte", "nome_hash", "key").join(unique(name_clusters(records)), "key").select("pos", (F.coalesce("fonte", F.lit("")) == "sefaz").alias("s"), "nome_hash", "house"))
    sefaz = housed.filter("s").select("house", F.col("pos").alias("p"), F.col("nome_hash").alias("h"))
    every = housed.select("house", F.col("pos").alias("q"), F.col("nome_hash").alias("g"), "s")
    pairs = blocked_join(sefaz, every, ["house"], 10_000).filter((F.col("h") != F.col("g")) & (~F.col("s") | (F.col("p") < F.col("q"))))
    return pairs.select(F.least("p", "q").alias("pos_a"), F.greatest("p", "q").alias("pos_b"))


def p6_houses(spark: SparkSession, directory: str) -> DataFrame:
    """The compact form: each row with a name and the house it names, by the smallest ``pos`` of the house, and the house's rows."""
    records = keyed_records(spark, directory)
    housed = cut(records.select("pos", "key").join(unique(name_clusters(records)), "key").select("pos", "house"))
    heads = housed.groupBy("house").agg(F.min("pos").alias("casa"), F.count("*").alias("registros"))
    return housed.join(heads, "house").select("pos", "casa", "registros")


QUERIES = {"p6_found": p6_found, "p6_houses": p6_houses}
SQL: dict[str, str] = {}
