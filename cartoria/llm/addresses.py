"""Problem 4: the same postal address written differently.

Multi-pass sorted neighbourhoods: parsed addresses, one row for each distinct spelling, are sorted three times, led by the area, by the street and
by the town; in each order an address is compared with the ones in a window after it.
The comparison is strict on number, letter and unit marks that belong to the number, tolerates edits and transpositions in the street, and
wants one area: the same first half of the postcode, or the same neighbourhood and town.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from cartoria.functions.lineage import cut
from cartoria.llm.address_parse import district_key, parse, town_key
from cartoria.llm.linkage import close_words
from cartoria.operators.components import components
from cartoria.operators.skew import blocked_join, small
from cartoria.sources.tables import table

WINDOW = 10
PARSED = ["kind", "street", "number", "district", "town", "postcode"]


def address_parts(address: str | None, district: str | None, town: str | None, postcode: str | None) -> tuple[str, ...] | None:
    """What ``PARSED`` names, of one row; None where its address names no street. What the address leaves out comes from the row's own columns; nothing known is ''."""
    found = parse(address)
    if not found.street:
        return None
    known = town_key(town or "")
    placed = found.district == known and known != "" and not found.town  # what looked like a neighbourhood is the town
    area = "" if placed else found.district.removesuffix(" " + " ".join(w for w in known.split() if w not in ("do", "da", "de", "dos", "das"))) if known and not found.town else found.district
    digits = "".join(c for c in postcode or "" if c in "0123456789")
    return found.kind, found.street, found.number, area or district_key(district or ""), found.town or known, found.postcode or (digits if len(digits) == 8 else "")


def parsed_addresses(df: DataFrame, id: str, address: str, district: str, town: str, postcode: str) -> DataFrame:
    """``id, kind, street, number, district, town, postcode`` of every row whose address names a street."""
    kind = df.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [address_parts(*row) for row in zip(*(batch.column(k).to_pylist() for k in range(1, 5)))]
            kept = [i for i, f in enumerate(found) if f]
            columns = list(zip(*(found[i] for i in kept))) if kept else [[] for _ in PARSED]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), *[pa.array(c, pa.string()) for c in columns]], [id, *PARSED])

    rows = df.select(id, *[F.col(c).cast("string") for c in (address, district, town, postcode)]).filter(F.col(address).isNotNull())
    return rows.mapInArrow(run, f"`{id}` {kind}, " + ", ".join(f"{c} string" for c in PARSED))


def ends(text: Column) -> Column:
    """The first and the last four letters of a name's last word: two names at most two edits apart nearly always share one of them."""
    last = F.element_at(F.split(text, " "), -1)
    return F.array_distinct(F.array(F.concat(F.lit("<"), F.substring(last, 1, 4)), F.concat(F.lit(">"), F.right(last, F.lit(4)))))


def coded_area() -> Column:
    """The area that a postcode names by its first five digits."""
    return F.when(F.length("postcode") == 8, F.substring("postcode", 1, 5))


def near_areas(parsed: DataFrame) -> DataFrame:
    """``town, district, near_area`` of the neighbourhoods of rows without a postcode that lead to a postcode's area."""
    coded = parsed.withColumn("area", coded_area())
    counts = coded.filter(F.col("area").isNotNull() & (F.col("town") != "") & (F.col("district") != "")).groupBy("area", "town", "district").count()
    names = counts.groupBy("area").agg(F.max(F.struct("count", "town", "district")).alias("m")).select("area", "m.town", F.col("m.district").alias("name"), "m.count")
    bare = coded.filter(F.col("area").isNull() & (F.col("district") != "")).select("town", "district").distinct()
    return (
        bare.withColumn("end", F.explode(ends(F.col("district"))))
        .join(names.withColumn("end", F.explode(ends(F.col("name")))), ["town", "end"])
        .withColumn("far", F.levenshtein("district", "name", 2))
        .filter(F.col("far") >= 0)
        .groupBy("town", "district")
        .agg(F.min(F.struct("far", -F.col("count"), "area")).alias("m"))
        .select("town", "district", F.col("m.area").alias("near_area"))
    )


def with_area(parsed: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """``parsed`` with ``area``: one name for a neighbourhood of a town, however it is given.

    The first five digits of a postcode name an area. The commonest spelling that all rows give it tells which
    (town, neighbourhood) it is; rows without a postcode find it by that spelling, or by the closest one in their town
    at most two edits away, sought among those that begin or end alike. Where neither leads to a postcode the spelling itself is the area.
    ``near`` has what ``near_areas`` found, where it is known.
    """
    near = small(near_areas(parsed) if near is None else near)
    return parsed.join(near, ["town", "district"], "left").withColumn("area", F.coalesce(coded_area(), "near_area", F.concat_ws("|", "town", "district"))).drop("near_area")


def same_street(a: str, b: str) -> Column:
    """Whether two street names can be one: tolerant words, an initial for the first word, or the first word left out."""
    x, y = F.split(F.col(f"{a}.street"), " "), F.split(F.col(f"{b}.street"), " ")
    last = close_words(F.element_at(x, -1), F.element_at(y, -1))
    fx, fy = F.get(x, F.lit(0)), F.get(y, F.lit(0))
    first = (F.size(x) < 2) | (F.size(y) < 2) | close_words(fx, fy) | ((F.length(fx) == 1) & fy.startswith(fx)) | ((F.length(fy) == 1) & fx.startswith(fy))
    joined = F.levenshtein(F.replace(F.col(f"{a}.street"), F.lit(" ")), F.replace(F.col(f"{b}.street"), F.lit(" ")), 2).between(0, 2)
    return (last & first) | (joined & (F.length(f"{a}.street") >= 8))


def same_area(a: str, b: str) -> Column:
    """Whether two addresses can lie in one area: one postcode area, or one town and neighbourhoods at most two edits apart.

    An area by postcode doesn't hold against another town that both name.
    """
    one_town = (F.col(f"{a}.town") == F.col(f"{b}.town")) | (F.col(f"{a}.town") == "") | (F.col(f"{b}.town") == "")
    named = (F.col(f"{a}.district") != "") & (F.levenshtein(f"{a}.district", f"{b}.district", 2) >= 0)
    known = (F.col(f"{a}.town") == F.col(f"{b}.town")) & (F.col(f"{a}.town") != "")
    return ((F.col(f"{a}.area") == F.col(f"{b}.area")) & (one_town | F.col(f"{a}.area").rlike("^[0-9]{5}$"))) | (known & named)


def neighbourhood_pairs(spellings: DataFrame, block: list[Column], order: list[Column], window: int) -> DataFrame:
    """Pairs ``a``, ``b`` of spellings at most ``window`` places apart in an order; ``block`` is the order's leading part."""
    record = F.struct("key", "area", "town", "district", "kind", "street")
    following = F.collect_list(record).over(W.partitionBy(*block).orderBy(*order, "key").rowsBetween(1, window))
    return spellings.select(record.alias("a"), following.alias("_f")).filter(F.size("_f") > 0).select("a", F.explode("_f").alias("b"))


def torn(matched: DataFrame, lacks: Column, trait: Column) -> DataFrame:
    """``key`` of the spellings that lack something which the spellings they match have in different forms, so that they could be either."""
    named = matched.filter(lacks & (trait != "")).groupBy("key").agg(F.min(trait).alias("one"), F.max(trait).alias("other"))
    initial = (F.length("one") == 1) & F.startswith("other", F.col("one"))
    alike = F.levenshtein("one", "other") * 2 < F.greatest(F.length("one"), F.length("other"))
    return named.filter(~alike & ~initial).select("key")


def address_locations(parsed: DataFrame, id: str, window: int = WINDOW) -> DataFrame:
    """``id, location``: the place of each row whose address has a house number; further columns of ``parsed`` stay.

    ``parsed`` comes from ``parsed_addresses``. Equal spellings are one before any comparison, so copies, however many, cost nothing
    in the passes. An address without a kind of street joins one with a kind only if just one kind
    of that street and number is near, and a street of one word joins a longer one only if all it could be begin alike. A spelling is named by a 64-bit hash of its components.
    """
    parts = ["area", "town", "district", "kind", "street", "number"]
    others = [c for c in parsed.columns if c not in {id, "postcode", *parts}]
    rows = cut(with_area(parsed.filter(F.col("number") != "")).select(id, *others, *parts).withColumn("key", F.xxhash64(*parts)))
    spellings = cut(rows.select("key", *parts).distinct())
    words = F.split("street", " ")
    last, first = F.element_at(words, -1), F.get(words, F.lit(0))
    passes = [
        neighbourhood_pairs(spellings, [F.col("area"), F.col("number")], [last, first], window),  # area, number, street
        neighbourhood_pairs(spellings, [F.substring(last, 1, 3), F.col("number")], [F.col("town"), first, F.col("district")], window),  # street, number, town
        neighbourhood_pairs(spellings.filter(F.col("town") != ""), [F.col("town"), F.col("number")], [first, F.reverse(last), F.col("district")], window),  # town, number, street from its other end
    ]
    pairs = passes[0]
    for more in passes[1:]:
        pairs = pairs.unionByName(more)
    kinds = (F.col("a.kind") == F.col("b.kind")) | (F.col("a.kind") == "") | (F.col("b.kind") == "")
    side = lambda x, y: [F.col(f"{x}.key").alias(f"key{y}"), F.col(f"{x}.kind").alias(f"kind{y}"), F.when(F.instr(f"{x}.street", " ") > 0, F.substring_index(f"{x}.street", " ", 1)).otherwise("").alias(f"first{y}")]
    matched = cut(pairs.filter(kinds & same_street("a", "b") & same_area("a", "b")).select(*side("a", ""), *side("b", "_b")).distinct())
    sided = matched.unionByName(matched.select(*[F.col(f"{c}_b").alias(c) for c in ("key", "kind", "first")], *[F.col(c).alias(f"{c}_b") for c in ("key", "kind", "first")]))
    either = torn(sided, F.col("kind") == "", F.col("kind_b")).unionByName(torn(sided, F.col("first") == "", F.col("first_b"))).distinct()
    edges = matched.join(either, "key", "left_anti").join(either.withColumnRenamed("key", "key_b"), "key_b", "left_anti")
    roots = components(edges, "key", "key_b")
    return rows.join(roots.withColumnRenamed("node", "key"), "key", "left").select(id, *others, F.coalesce("root", "key").alias("location"))


def places(spark: SparkSession, directory: str) -> DataFrame:
    """``pos, text, location`` of the records that have a place; ``text`` is a hash of the address as stored."""
    rows = table(spark, directory, "terreiros_all_sources_v2").select(F.struct("pos", F.xxhash64("endereco").alias("text")).alias("r"), "endereco", "bairro", "municipio", "cep")
    parsed = parsed_addresses(rows, "r", "endereco", "bairro", "municipio", "cep").select("r.*", *PARSED)
    return address_locations(cut(parsed), "pos")


def p4_found(spark: SparkSession, directory: str) -> DataFrame:
    """Pairs of rows at one place whose addresses are different strings."""
    located = cut(places(spark, directory))
    a = located.select("location", F.col("pos").alias("pos_a"), F.col("text").alias("text_a"))
    b = located.select("location", F.col("pos").alias("pos_b"), F.col("text").alias("text_b"))
    return blocked_join(a, b, ["location"], 10_000).filter((F.col("pos_a") < F.col("pos_b")) & (F.col("text_a") != F.col("text_b"))).select("pos_a", "pos_b")


def p4_places(spark: SparkSession, directory: str) -> DataFrame:
    """The compact form: each row with a house number and its place, named by the smallest ``pos`` there, and the rows there."""
    located = cut(places(spark, directory))
    heads = located.groupBy("location").agg(F.min("pos").alias("lugar"), F.count("*").alias("registros"))
    return located.join(heads, "location").select("pos", "lugar", "registros")


QUERIES = {"p4_found": p4_found, "p4_places": p4_places}
SQL: dict[str, str] = {}
