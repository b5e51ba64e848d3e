"""Problem 2: the best representative of each group of records.

``survivors`` chooses field by field under fixed preferences, which is what p2_found asks for.
``truth_discovery`` is the iterative method: votes weighted by the estimated reliability of their source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartoria.functions.lineage import cut
from cartoria.operators.skew import small
from cartoria.sources.tables import table

# Remarks that stand for an unknown address.
NO_ADDRESS = ["", "-", "?", "n/i", "a confirmar", "sem endereço", "sem endereco", "não informado", "nao informado", "não consta", "nao consta"]


def phone_digits(phone: Column) -> Column:
    """The digits of a phone number without the country code 55 before 10 or 11 others."""
    digits = F.regexp_replace(phone, "[^0-9]", "")
    return F.when(F.length(digits).isin(12, 13) & digits.startswith("55"), F.substr(digits, F.lit(3))).otherwise(digits)


def usable_phone(phone: Column) -> Column:
    """True for 10 or 11 digits, at least three of them different, not beginning with 00; null counts as unusable."""
    digits = phone_digits(phone)
    varied = F.size(F.array_distinct(F.split(digits, ""))) >= 3
    return F.coalesce(F.length(digits).isin(10, 11) & varied & ~digits.startswith("00"), F.lit(False))


def usable_address(address: Column) -> Column:
    """True if the text names a street: it holds a letter and isn't one of the remarks for unknown."""
    plain = F.lower(F.regexp_replace(address, r"(?U)^\s+|\s+$", ""))
    return F.coalesce(~plain.isin(NO_ADDRESS) & plain.rlike(r"\p{L}"), F.lit(False))


def own_id() -> Column:
    """The id that a row's own source gave it; null where there is none."""
    by = {"ceao": "ceao_id", "google": "place_id", "osm": "osm_id", "sefaz": "sefaz_codigo"}
    out = F.lit(None).cast("string")
    for source, column in by.items():
        out = F.when(F.col("fonte") == source, F.nullif(F.col(column), F.lit(""))).otherwise(out)
    return out


def observations(spark: SparkSession, directory: str) -> DataFrame:
    """Rows with an id of their own source, what is usable in them and how trusted their channel is."""
    rows = table(spark, directory, "terreiros_all_sources_v2").select(
        "pos", "fonte", own_id().alias("id_fonte"), "fonte_detalhe", "telefone", "rating", "reviews", "endereco", "coletado_em"
    ).filter(F.col("id_fonte").isNotNull())
    channels = table(spark, directory, "canais_coleta").groupBy("fonte_detalhe").agg(F.max("confianca").alias("confianca"))
    return rows.join(small(channels), "fonte_detalhe", "left").select(
        "pos", "fonte", "id_fonte", "fonte_detalhe", "telefone", "rating", "reviews", "endereco",
        F.coalesce("confianca", F.lit(0)).alias("confianca"),
        F.coalesce(F.col("coletado_em").cast("timestamp_ntz"), F.expr("timestamp_ntz'0001-01-01'")).alias("quando"),
        usable_phone(F.col("telefone")).alias("tem_telefone"),
        F.coalesce(F.col("rating").between(1.0, 5.0), F.lit(False)).alias("tem_rating"),
        F.coalesce(F.col("reviews") >= 1, F.lit(False)).alias("tem_reviews"),
        usable_address(F.col("endereco")).alias("tem_endereco"),
    )


def survivors(rows: DataFrame, keys: list[str], id: str, choices: dict[str, tuple[Column, list[Column]]]) -> DataFrame:
    """For each group of at least two rows the chosen row's ``id`` by choice: ``keys`` and a column for each choice.

    A choice is (which rows may be chosen, what to maximise, most important first); the last tie goes
    to the smaller id. Where no row may be chosen the column is 0. Everything is one aggregation of
    maxima, combined before the shuffle, so a group of any size is reduced where its rows are.
    """
    best = [F.max(F.when(may, F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], (-F.col(id)).alias("id")))).alias(name) for name, (may, order) in choices.items()]
    grouped = rows.groupBy(*keys).agg(F.count("*").alias("_n"), *best).filter(F.col("_n") > 1)
    return grouped.select(*keys, *[F.coalesce(-F.col(f"{name}.id"), F.lit(0)).cast("long").alias(name) for name in choices])


def p2_found(spark: SparkSession, directory: str) -> DataFrame:
    """The chosen rows of each source id with several rows."""
    rows = observations(spark, directory)
    usable = sum((F.col(f"tem_{f}").cast("int") for f in ("rating", "reviews", "endereco")), F.col("tem_telefone").cast("int"))
    when = F.col("quando")
    return survivors(rows, ["fonte", "id_fonte"], "pos", {
        "pos_base": (F.lit(True), [usable, when]),
        "pos_telefone": (F.col("tem_telefone"), [when]),
        "pos_rating": (F.col("tem_rating"), [when]),
        "pos_reviews": (F.col("tem_reviews"), [F.col("reviews"), when]),
        "pos_endereco": (F.col("tem_endereco"), [F.col("confianca"), when]),
    })


def truth_discovery(claims: DataFrame, source: str = "source", trust: str | None = None, tolerance: float = 1e-3, most: int = 200) -> DataFrame:
    """The best supported value of each item: ``item, value, support, confidence``.

    ``claims`` has one row for each claim: ``item`` (an object's field), ``value`` and ``source``; claims without an item
    or a value are left out, a null source votes as the source ''. Equal claims are counted first, so an item
    with very many rows shrinks before any shuffle. Sources begin with the reliability in the column ``trust``, between 0 and 1, or with 0.8. Each round
    (1) gives a value the sum of its sources' votes, a vote being the log-odds of the source's reliability, and a share of belief
    in proportion to the exponential of that sum, and
    (2) sets a source's reliability halfway to the mean share of its claims, smoothed by one claim of 0.5,
    until no reliability moves by more than ``tolerance``; raises if ``most`` rounds don't bring that about. Ties go to the smaller value.
    Reliabilities stay a table; only the largest change is read by the driver.
    """
    prior = F.col(trust) if trust else F.lit(0.8)
    counted = claims.filter(F.col("item").isNotNull() & F.col("value").isNotNull()).groupBy("item", "value", F.coalesce(F.col(source), F.lit("")).alias("s")).agg(F.count("*").alias("n"), F.max(prior).alias("w"))
    counted = cut(counted.repartition("item"))
    weights = cut(counted.groupBy("s").agg(F.max("w").alias("w")))
    counted = counted.drop("w")

    def shares(weights: DataFrame) -> DataFrame:
        sure = F.least(F.greatest(F.col("w"), F.lit(0.05)), F.lit(0.99))
        votes = counted.join(small(weights), "s").groupBy("item", "value").agg(F.sum(F.log(sure / (1 - sure))).alias("support"))
        most = votes.groupBy("item").agg(F.max("support").alias("most"))
        belief = votes.join(most, "item").withColumn("belief", F.exp(F.col("support") - F.col("most")))
        totals = belief.groupBy("item").agg(F.sum("belief").alias("total"))
        return belief.join(totals, "item").withColumn("share", F.col("belief") / F.col("total"))

    for _ in range(most):
        told = counted.join(shares(weights).select("item", "value", "share"), ["item", "value"])
        sums = told.groupBy("s").agg(F.sum(F.col("n") * F.col("share")).alias("got"), F.sum("n").alias("of"))
        following = cut(sums.join(weights, "s").select("s", ((F.col("w") + (F.col("got") + 0.5) / (F.col("of") + 1)) / 2).alias("w"), F.col("w").alias("before")))
        moved = following.agg(F.max(F.abs(F.col("w") - F.col("before")))).first()[0]
        weights = following.select("s", "w")
        if moved is None or moved <= tolerance:
            break
    else:
        raise RuntimeError("reliabilities did not settle")
    final = cut(shares(weights).select("item", "value", "support", "share"))
    top = final.groupBy("item").agg(F.max("support").alias("support"))
    return final.join(top, ["item", "support"]).groupBy("item").agg(F.min("value").alias("value"), F.max("support").alias("support"), F.max("share").alias("confidence"))


def field_values(rows: DataFrame) -> DataFrame:
    """``fonte, id_fonte, pos, fonte_detalhe, confianca, campo, value``: the usable values of each observation in a form in which equal ones are equal."""
    values = {
        "telefone": (F.col("tem_telefone"), phone_digits(F.col("telefone"))),
        "rating": (F.col("tem_rating"), F.format_number("rating", 1)),
        "reviews": (F.col("tem_reviews"), F.col("reviews").cast("string")),
        "endereco": (F.col("tem_endereco"), F.regexp_replace(F.lower("endereco"), r"[^\p{L}\p{M}\p{N}]+", " ")),
    }
    fields = F.array(*[F.struct(F.lit(f).alias("campo"), F.when(ok, v).alias("value")) for f, (ok, v) in values.items()])
    return rows.select("fonte", "id_fonte", "pos", "fonte_detalhe", "confianca", F.explode(fields).alias("c")).select("fonte", "id_fonte", "pos", "fonte_detalhe", "confianca", "c.*").filter(F.col("value").isNotNull())


def p2_truth(spark: SparkSession, directory: str) -> DataFrame:
    """For each source id with several rows and each field: the value that truth discovery supports most; channels begin with their trust."""
    rows = observations(spark, directory)
    several = rows.groupBy("fonte", "id_fonte").count().filter(F.col("count") > 1).select("fonte", "id_fonte")
    claims = field_values(rows.join(several, ["fonte", "id_fonte"])).select(
        F.struct("fonte", "id_fonte", "campo").alias("item"), "value", F.col("fonte_detalhe").alias("source"), (0.6 + 0.3 * F.col("confianca") / (F.col("confianca") + 1)).alias("trust")
    )
    best = truth_discovery(claims, trust="trust")
    return best.select("item.fonte", "item.id_fonte", "item.campo", F.col("value").alias("valor"), F.round("confidence", 6).alias("confianca"))


def p2_agreement(spark: SparkSession, directory: str) -> DataFrame:
    """``campo, itens, iguais``: of the fields for which p2_found names a row, how many get the same value from truth discovery."""
    fields = ["telefone", "rating", "reviews", "endereco"]
    chosen = p2_found(spark, directory).select("fonte", "id_fonte", F.explode(F.array(*[F.struct(F.lit(f).alias("campo"), F.col(f"pos_{f}").alias("pos")) for f in fields])).alias("c")).select("fonte", "id_fonte", "c.*")
    values = field_values(observations(spark, directory)).select("pos", "campo", "value")
    both = chosen.join(values, ["pos", "campo"]).join(p2_truth(spark, directory), ["fonte", "id_fonte", "campo"])
    return both.groupBy("campo").agg(F.count("*").alias("itens"), F.count_if(F.col("value") == F.col("valor")).alias("iguais"))


QUERIES = {"p2_found": p2_found, "p2_truth": p2_truth, "p2_agreement": p2_agreement}

SQL = {
    "p2_found": """
WITH r AS (
  SELECT pos, fonte, CASE fonte WHEN 'ceao' THEN ceao_id WHEN 'google' THEN place_id WHEN 'osm' THEN osm_id WHEN 'sefaz' THEN sefaz_codigo END AS id_fonte,
    coletado_em, coalesce(coletado_em, TIMESTAMP '1900-01-01') AS q, rating, reviews, coalesce(c.confianca, 0) AS conf,
    regexp_replace(telefone, '[^0-9]', '', 'g') AS d0, lower(trim(endereco)) AS e
  FROM terreiros_all_sources_v2 t LEFT JOIN canais_coleta c ON t.fonte_detalhe = c.fonte_detalhe
), s AS (
  SELECT *, CASE WHEN length(d0) IN (12, 13) AND d0[1:2] = '55' THEN d0[3:] ELSE d0 END AS d FROM r WHERE id_fonte IS NOT NULL AND id_fonte <> ''
), u AS (
  SELECT *, coalesce(length(d) IN (10, 11) AND len(list_distinct(string_split(d, ''))) >= 3 AND d[1:2] <> '00', false) AS ut,
    coalesce(rating BETWEEN 1 AND 5, false) AS ur, coalesce(reviews >= 1, false) AS uv,
    coalesce(e NOT IN ('', '-', '?', 'n/i', 'a confirmar', 'sem endereço', 'não informado', 'não consta') AND regexp_matches(e, '\\p{L}'), false) AS ue
  FROM s
)
SELECT fonte, id_fonte,
  first(pos ORDER BY ut::INT + ur::INT + uv::INT + ue::INT DESC, q DESC, pos) AS pos_base,
  coalesce(first(pos ORDER BY q DESC, pos) FILTER (ut), 0) AS pos_telefone,
  coalesce(first(pos ORDER BY q DESC, pos) FILTER (ur), 0) AS pos_rating,
  coalesce(first(pos ORDER BY reviews DESC, q DESC, pos) FILTER (uv), 0) AS pos_reviews,
  coalesce(first(pos ORDER BY conf DESC, q DESC, pos) FILTER (ue), 0) AS pos_endereco
FROM u GROUP BY fonte, id_fonte HAVING count(*) > 1""",
}
