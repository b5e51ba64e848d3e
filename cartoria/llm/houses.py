"""Records of houses made comparable: the own words of the name, the town, and how common the words are."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartoria.functions.lineage import cut
from cartoria.llm.address_parse import district_key, town_key
from cartoria.llm.addresses import PARSED, address_parts
from cartoria.llm.name_parse import GENERIC, LEADERS, parse_name
from cartoria.operators.components import components
from cartoria.operators.skew import small, unique
from cartoria.sources.tables import table


NUMBER = PARSED.index("number")
#: What ``parsed_names`` adds of an address with a house number.
ADDRESS = {"street": "a_street", "number": "a_number", "district": "a_district", "town": "a_town", "postcode": "a_postcode"}


def parsed_names(df: DataFrame, id: str, name: str, town: str, district: str, address: tuple[str, str] | None = None) -> DataFrame:
    """``id, words, tail, town, district``: own words of the name in alphabetical order; null, empty and wholly generic names have '' for words.

    With the columns of an ``address`` and its postcode it also has the parts of ``ADDRESS``, null for a row whose address has no street or house number.
    """
    kind = df.schema[id].dataType.simpleString()
    columns = ["words", "tail", "town", "district", *(ADDRESS.values() if address else ())]
    at = [PARSED.index(c) for c in ADDRESS]
    nothing = (None,) * len(PARSED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, given, districts, *place = (batch.column(k).to_pylist() for k in range(1, batch.num_columns))
            towns = [town_key(t) if t else "" for t in given]
            found = [parse_name(n, t) for n, t in zip(names, towns)]
            told = [[" ".join(sorted(h.words)) for h in found], [" ".join(h.tail) for h in found], towns, [district_key(d) if d else "" for d in districts]]
            if place:
                parts = [address_parts(a, d, t, p) if a else None for a, d, t, p in zip(place[0], districts, given, place[1])]
                parts = [p if p and p[NUMBER] else nothing for p in parts]
                told += [[p[k] for p in parts] for k in at]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.string()) for c in told]], [id, *columns])

    return df.select(id, *[F.col(c).cast("string") for c in (name, town, district, *(address or ()))]).mapInArrow(run, f"`{id}` {kind}, " + ", ".join(f"{c} string" for c in columns))


def source_key() -> Column:
    """Hash of a row's source and the first id that isn't empty; null where there is no id or source."""
    given = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("ceao_id", "place_id", "osm_id", "sefaz_codigo")])
    return F.when(given.isNotNull() & F.col("fonte").isNotNull(), F.xxhash64("fonte", given))


def house_records(spark: SparkSession, directory: str, extra: dict[str, Column] | None = None, sources: list[str] | None = None, addressed: bool = False) -> DataFrame:
    """One row for each record with a name, of some ``sources`` or of all: ``pos, fonte, source, code``, the ``extra`` columns, ``words, tail, town, district``.

    ``code`` is the first half of the postcode, from its column or the address. Unknown text is ''. ``addressed`` adds the parts of ``ADDRESS``.
    """
    rows = table(spark, directory, "terreiros_all_sources_v2").filter(F.col("nome").isNotNull() & (F.col("fonte").isin(sources) if sources else F.lit(True)))
    postcode = F.coalesce(F.nullif(F.regexp_replace("cep", "[^0-9]", ""), F.lit("")), F.nullif(F.regexp_replace(F.regexp_extract("endereco", r"(\d{5}-?\d{3})", 1), "-", ""), F.lit("")))
    code = F.when(F.coalesce("municipio", F.lit("")) == "", postcode)  # read only where it has to tell the town
    own = F.struct("pos", "fonte", source_key().alias("source"), F.when(F.length(code) == 8, F.substring(code, 1, 5)).alias("code"), *[c.alias(n) for n, c in (extra or {}).items()])
    # everything passes Python once: what isn't a name travels beside it
    address = ("endereco", "cep") if addressed else None
    names = parsed_names(rows.select(own.alias("r"), "nome", "municipio", "bairro", *(address or ())), "r", "nome", "municipio", "bairro", address)
    return names.select("r.*", *[c for c in names.columns if c != "r"])


def town_codes(spark: SparkSession, directory: str) -> DataFrame:
    """``code, code_town``: the town that most records with a postcode of this first half name."""
    rows = table(spark, directory, "terreiros_all_sources_v2").filter(F.col("cep").isNotNull() & F.col("municipio").isNotNull())
    digits = F.regexp_replace("cep", "[^0-9]", "")
    counts = rows.select(F.substring(digits, 1, 5).alias("code"), F.length(digits).alias("l"), "municipio").filter(F.col("l") == 8).groupBy("code", "municipio").count()
    top = counts.groupBy("code").agg(F.max(F.struct("count", "municipio")).alias("m")).select("code", F.col("m.municipio").alias("municipio"))
    keyed = F.udf(lambda t: town_key(t) if t else "", "string")  # one row for each code
    return cut(top.select("code", keyed("municipio").alias("code_town")))


def with_towns(records: DataFrame, codes: DataFrame) -> DataFrame:
    """``records`` with the missing towns that their postcodes or the tails of their names tell; a tail that is no town joins the words.

    A tail is a place if some record of the corpus has it for its town, or if it is the row's own town but for two letters.
    """
    plain = records.filter(((F.col("town") != "") | F.col("code").isNull()) & (F.col("tail") == "")).drop("code", "tail")
    towns = records.filter(F.col("town") != "").select(F.col("town").alias("tail")).distinct().withColumn("place", F.lit(True))
    other = records.filter(((F.col("town") == "") & F.col("code").isNotNull()) | (F.col("tail") != "")).join(codes, "code", "left").join(towns, "tail", "left")
    told = F.coalesce(F.nullif("town", F.lit("")), "code_town", F.when(F.col("place"), F.col("tail")), F.lit(""))
    placed = F.col("place").isNotNull() | (F.levenshtein("tail", "town", 2) >= 0)
    more = F.array_join(F.array_sort(F.array_distinct(F.array_union(F.split("words", " "), F.array_except(F.split("tail", " "), F.array(*[F.lit(w) for w in sorted(GENERIC | LEADERS)]))))), " ")
    resolved = other.withColumn("words", F.when((F.col("tail") == "") | placed, F.col("words")).otherwise(more)).withColumn("town", told)
    return plain.unionByName(resolved.select(*plain.columns))


def keyed_records(spark: SparkSession, directory: str, extra: dict[str, Column] | None = None, sources: list[str] | None = None) -> DataFrame:
    """House records with their keys."""
    return with_keys(cut(house_records(spark, directory, extra, sources)), town_codes(spark, directory))


def with_keys(records: DataFrame, codes: DataFrame) -> DataFrame:
    """``records`` with their towns and ``key``, the hash of their reading: the town and the own words. A record without own words is a reading of its own."""
    rows = with_towns(records, codes)
    return rows.withColumn("key", F.when(F.col("words") == "", F.xxhash64("pos")).otherwise(F.xxhash64("town", "words")))


def readings(records: DataFrame) -> DataFrame:
    """The distinct readings, written: ``key, hash, town, words, support, district, common, initial``; ``hash`` is the records' key.

    ``district`` is a hash, null where no record names one. ``key`` numbers the readings; numbers take less room in a shuffle than hashes.
    ``support`` counts the records, so copies and repeated deliveries only add to it. ``common`` tells that every word is about as frequent as
    words are: at least a quarter of the mean frequency that an occurrence of a word meets. Two names of common words are two names;
    whoever mistypes a word makes an uncommon one. ``initial`` tells that an initial stands for a word.
    """
    raw = cut(records.groupBy("key", "town", "words").agg(F.count("*").alias("support"), F.max(F.when(F.col("district") != "", F.xxhash64("district"))).alias("district")))
    word = F.explode(F.split("words", " ")).alias("word")
    words = cut(raw.filter(F.col("words") != "").select("support", word).groupBy("word").agg(F.sum("support").alias("n")))
    mean = words.agg(F.try_divide(F.sum(F.col("n") * F.col("n")), F.sum("n")).alias("m")).first()["m"] or 0.0
    usual = words.filter((F.col("n") >= mean / 4) & (F.length("word") > 1)).select("word", F.lit(True).alias("usual"))
    each = raw.repartition("key").select("*", word)  # what follows stays where it is
    common = each.join(small(usual), "word", "left").groupBy(*raw.columns).agg(F.min(F.coalesce("usual", F.lit(False))).alias("common")).sortWithinPartitions("key")  # one order of numbers, whoever comes first
    initial = F.col("words").rlike(r"(^| )[a-z0-9]( |$)")
    return cut(common.select(F.monotonically_increasing_id().alias("key"), F.col("key").alias("hash"), "town", "words", "support", "district", "common", initial.alias("initial")))


def source_units(records: DataFrame, names: DataFrame) -> DataFrame:
    """``names`` with ``unit`` and its support ``n``: readings that one source id carries, in several observations, are one unit."""
    carried = records.filter(F.col("source").isNotNull() & (F.col("words") != "")).select("source", "key")
    ends = carried.groupBy("source").agg(F.min("key").alias("center"), F.max("key").alias("last")).filter(F.col("center") != F.col("last"))
    tied = carried.join(unique(ends.select("source", "center")), "source").filter(F.col("key") != F.col("center")).select("key", "center")
    units = components(tied, "key", "center").select(F.col("node").alias("hash"), F.col("root").alias("unit"))
    known = names.select("hash", "key", "support").join(units, "hash")  # few: only readings that share an id
    numbers = known.join(known.groupBy("unit").agg(F.min("key").alias("number"), F.sum("support").alias("n")), "unit").select("hash", F.col("number").alias("unit"), "n")
    return names.join(unique(numbers), "hash", "left").withColumns({"unit": F.coalesce("unit", "key"), "n": F.coalesce("n", "support")})
