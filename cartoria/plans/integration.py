"""Integration of sources and publication of documents: records, aliases, metadata, versions, and what is written read back."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cartoria.functions.geo import in_box
from cartoria.functions.lineage import ensure_checkpoint_dir
from cartoria.functions.text import stripped
from cartoria.operators.classify import RuleSet, refine_ambiguous, scan_buckets
from cartoria.operators.keyed import first_wins, globally_ranked
from cartoria.operators.records import merged_map, narrow_features, normalized_primary, rules_table
from cartoria.plans.registry import source_told
from cartoria.plans.review import EXPORT, decision_latest, export_rows, review_queue_full
from cartoria.plans.rules import KEEP, LABELLED, RULES
from cartoria.plans.screening import google_names, names, suspects
from cartoria.sources.documents import csv_table, decision_store, geojson, html_pages, json_array, json_path, optional_csv
from cartoria.sources.elements import flattened_tags, matching, named_elements
from cartoria.sources.sinks import write_csv, write_geojson, write_json
from cartoria.sources.tables import table


def registry(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "terreiros_all_sources_v2")


def scratch_path(spark: SparkSession) -> str:
    """A new place in the shared folder, which ``clear`` empties."""
    return f"{ensure_checkpoint_dir(spark)}/cut-{uuid.uuid4().hex}"


def primary_normalized(spark: SparkSession, directory: str) -> DataFrame:
    """The primary source as its raw rows come, with a page in ``raw_html``, made into registry records."""
    raw = registry(spark, directory).filter(F.col("fonte") == "ceao").select("pos", F.col("ceao_id").alias("id"), F.col("nome").alias("raw_html"), "nome", "lat", "lng", F.lit("x").alias("fonte"))
    made = normalized_primary(raw, "ceao", "CEAO")
    return made.select("pos", "ceao_id", "fonte", "fonte_detalhe", "geo_status", F.col("fontes")[0]["id"].alias("id"), F.lit("raw_html" in made.columns).alias("com_pagina"))


def alias_features(spark: SparkSession, directory: str) -> DataFrame:
    """Narrow features from records whose keys differ: a third of them names its fields in English, a third otherwise, and some lack them."""
    r = F.col("pos") % 3
    entry = lambda key, value: F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))
    pt = [entry("nome", F.col("nome")), entry("nacao", F.col("nacao")), entry("endereco", F.col("endereco")), entry("municipio", F.col("municipio"))]
    en = [entry("name", F.col("nome")), entry("address", F.col("endereco")), entry("addr:city", F.col("municipio"))]
    other = [entry("nome", F.lit(None)), entry("name", F.col("nome")), entry("tradicao", F.col("nacao")), entry("cidade", F.col("municipio"))]
    common = [entry("lat", F.col("lat")), entry("lng", F.col("lng")), entry("fonte", F.col("fonte"))]
    fields = F.map_from_entries(F.when(r == 0, F.array(*pt, *common)).when(r == 1, F.array(*en, *common)).otherwise(F.array(*other, *common)))
    return narrow_features(registry(spark, directory).select("pos", fields.alias("f")), "f").select("pos", "nome", "fonte", "nacao", "endereco", "municipio", "geo_status", "lat", "lng")


def metadata_merge(spark: SparkSession, directory: str) -> DataFrame:
    """Metadata of the version before under that of the new one, key by key, for each source."""
    counts = registry(spark, directory).groupBy(source_told().alias("fonte")).agg(F.count("*").cast("string").alias("n"), F.count_if(in_box(F.col("lat"), F.col("lng"))).cast("string").alias("m"))
    old = F.map_from_arrays(F.array(F.lit("versao"), F.lit("coleta"), F.lit("total")), F.array(F.lit("1.3"), F.lit("manual"), F.lit("0")))
    new = F.map_from_arrays(F.array(F.lit("versao"), F.lit("total"), F.lit("mapeados")), F.array(F.lit("2.1"), F.col("n"), F.col("m")))
    return counts.select("fonte", F.explode(merged_map(old, new)).alias("chave", "valor"))


def refined(spark: SparkSession, directory: str) -> DataFrame:
    ambiguous = scan_buckets(google_names(spark, directory), "nome", RULES).filter(F.col("bucket") == "ambiguous").drop("razao")
    return refine_ambiguous(ambiguous, "nome", KEEP, RuleSet(labelled=LABELLED, default_label="Não religioso (padrão)"))


def removed_names(spark: SparkSession, directory: str) -> DataFrame:
    """The names to remove: those the scan suspects and those that the refinement of the ambiguous ones confirms, each once."""
    second = refined(spark, directory).filter(F.col("decisao") == "remover").select(stripped(F.col("nome")).alias("nome"))
    return suspects(spark, directory).union(second).distinct()


def without_removed(spark: SparkSession, directory: str) -> DataFrame:
    """All records but those of one source whose name is to be removed; namesakes of other sources stay."""
    rows = names(spark, directory)
    gone = removed_names(spark, directory).withColumnRenamed("nome", "_gone")
    google = F.col("fonte").eqNullSafe("google")
    return rows.filter(~google).unionByName(rows.filter(google).join(gone, stripped(F.col("nome")) == F.col("_gone"), "left_anti"))


def removal_single_source(spark: SparkSession, directory: str) -> DataFrame:
    return without_removed(spark, directory).select("pos", "fonte", "nome")


def scan_stamp(spark: SparkSession, directory: str) -> DataFrame:
    """What the metadata say of a removal: the counts before and after and of each step."""
    total = names(spark, directory).agg(F.count("*").alias("total_original"))
    left = without_removed(spark, directory).agg(F.count("*").alias("total_limpo"))
    obvious = suspects(spark, directory).agg(F.count("*").alias("google_fp_obvios"))
    decided = refined(spark, directory).agg(F.count_if(F.col("decisao") == "remover").alias("google_fp_ambiguos"), F.count_if(F.col("decisao") == "manter").alias("google_mantidos_ambiguos"))
    one = total.crossJoin(left).crossJoin(obvious).crossJoin(decided)  # one row each
    return one.withColumns({"total_removido": F.col("total_original") - F.col("total_limpo"), "metodo": F.lit("triagem por regras")})


def suspects_ranked(spark: SparkSession, directory: str) -> DataFrame:
    """The suspects by reason and name, numbered from 1."""
    found = scan_buckets(google_names(spark, directory), "nome", RULES).filter(F.col("bucket") == "suspect").select("pos", "razao", stripped(F.col("nome")).alias("nome"))
    return globally_ranked(found, [F.col("razao"), F.col("nome"), F.col("pos")], "lugar")


def preview(spark: SparkSession, directory: str) -> DataFrame:
    """The first ten named rows: a look at what came in."""
    return names(spark, directory).filter(stripped(F.col("nome")) != "").orderBy("pos").limit(10).select("pos", "nome")


def rules_from_table(spark: SparkSession, directory: str) -> DataFrame:
    """Labels by rules that are read from a table, as many as the tables have towns, in the order of their first row."""
    towns = registry(spark, directory).filter(F.col("municipio").rlike(r"^[\p{L} ]+$")).groupBy(F.lower("municipio").alias("label")).agg(F.min("pos").alias("ord"))
    stored = scratch_path(spark)
    towns.select(F.lit("town").alias("kind"), "ord", "label", F.col("label").alias("pattern")).write.parquet(stored)
    rules = rules_table(spark.read.parquet(stored), "town")
    alternatives = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(pattern).alias("pattern")) for label, pattern in rules]) if rules else F.array().cast("array<struct<label:string,pattern:string>>")
    place = F.lower("endereco")
    found = F.get(F.filter(alternatives, lambda t: F.contains(place, t["pattern"])), F.lit(0))["label"]
    return registry(spark, directory).filter(F.col("endereco").isNotNull()).select("pos", found.alias("rotulo"))


def json_round_trip(spark: SparkSession, directory: str) -> DataFrame:
    """Records as one JSON document with metadata, read back by its path."""
    path = f"{scratch_path(spark)}/all.json"
    rows = registry(spark, directory).select("pos", F.col("pos").alias("id"), "nome", "fonte", "rating")
    write_json(rows, path, "pos", {"versao": "2.1", "total": rows.count()}, key="terreiros", pretty=True)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("nome", T.StringType()), T.StructField("fonte", T.StringType()), T.StructField("rating", T.DoubleType())])
    return json_path(spark, path, schema, "terreiros", "ordem").select(F.col("ordem").cast("long").alias("ordem"), "id", "nome", "fonte", "rating")


def array_round_trip(spark: SparkSession, directory: str) -> DataFrame:
    """Records as a JSON array; the place in it is their order."""
    path = scratch_path(spark)
    rows = registry(spark, directory).filter(F.col("fonte") == "osm").select("pos", "osm_id", "nome")
    document = rows.agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("pos", "osm_id", "nome"))), lambda r: F.struct(r["osm_id"].alias("osm_id"), r["nome"].alias("nome"))), {"ignoreNullFields": "false"}).alias("value"))
    document.write.text(path)
    schema = T.StructType([T.StructField("osm_id", T.StringType()), T.StructField("nome", T.StringType())])
    return json_array(spark, path, schema, "ordem").select(F.col("ordem").cast("long").alias("ordem"), "osm_id", "nome")


def geojson_round_trip(spark: SparkSession, directory: str) -> DataFrame:
    """Mapped records as a GeoJSON, written twice over the same name, compact and then indented, and read back."""
    path = f"{scratch_path(spark)}/map.geojson"
    rows = registry(spark, directory).filter(in_box(F.col("lat"), F.col("lng"))).select("pos", F.col("pos").alias("id"), "nome", "lat", "lng")
    write_geojson(rows, path, "pos")
    write_geojson(rows, path, "pos", pretty=True)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("nome", T.StringType())])
    return geojson(spark, path, schema, "ordem").select(F.col("ordem").cast("long").alias("ordem"), "id", "nome", "lat", "lng")


def csv_round_trip(spark: SparkSession, directory: str) -> DataFrame:
    """The curated ledger as a CSV in its order, read back as text; null becomes ''."""
    path = f"{scratch_path(spark)}/ledger.csv"
    rows = table(spark, directory, "exclusoes_curadas").select("nome", "latitude", "longitude", "motivo")
    ranked = globally_ranked(rows.withColumn("n", F.lit(1)), [F.col("nome"), F.col("latitude"), F.col("longitude"), F.col("motivo")], "ordem").drop("n")
    write_csv(ranked, path, "ordem")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("nome", "latitude", "longitude", "motivo")])
    return csv_table(spark, path, schema)


def csv_export(spark: SparkSession, directory: str) -> DataFrame:
    """The export with a byte-order mark, read back: its rows by status, and those with a reason."""
    path = f"{scratch_path(spark)}/revisao.csv"
    write_csv(export_rows(spark, directory), path, "ordem", bom=True)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in EXPORT])
    back = csv_table(spark, path, schema)
    return back.groupBy("status_revisao").agg(F.count("*").alias("n"), F.count_if(F.col("motivo_decisao") != "").alias("com_motivo"), F.count_distinct("review_id").alias("ids"))


def queue_document(spark: SparkSession, directory: str) -> DataFrame:
    """The review queue as a compact document in its order, read back."""
    path = f"{scratch_path(spark)}/fila.json"
    rows = review_queue_full(spark, directory).withColumn("ordem", F.col("lugar"))
    write_json(rows, path, "ordem", {"versao": "1.0"})
    fields = ["pos", "lugar", "sugestao", "status_revisao", "motivo_sugestao"]
    schema = T.StructType([T.StructField(c, T.LongType() if c in ("pos", "lugar") else T.StringType()) for c in fields])
    return json_path(spark, path, schema, "registros", "ordem").select((F.col("ordem") + 1).cast("long").alias("ordem"), *fields)


def decision_store_round_trip(spark: SparkSession, directory: str) -> DataFrame:
    """The decisions that hold, saved as a keyed store of JSON lines and loaded again."""
    path = scratch_path(spark)
    decision_latest(spark, directory).write.json(path)
    return decision_store(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in ("review_id", "status_revisao", "motivo_decisao", "revisado_em")]))


def optional_exclusions(spark: SparkSession, directory: str) -> DataFrame:
    """Without a ledger nothing is excluded: the rows of an optional file that isn't there, beside the records."""
    schema = T.StructType([T.StructField("nome", T.StringType())])
    missing = optional_csv(spark, None, schema)
    rows = registry(spark, directory).filter(F.col("nome").isNotNull()).select("pos", "nome")
    return rows.join(missing.withColumnRenamed("nome", "_n"), F.col("nome") == F.col("_n"), "left_anti").agg(F.count("*").alias("registros"))


def dataset_rewrite(spark: SparkSession, directory: str) -> DataFrame:
    """The registry after a removal as a new version beside the old one, read back and counted."""
    path = f"{scratch_path(spark)}/v=2"
    without_removed(spark, directory).write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path).groupBy(source_told().alias("fonte")).agg(F.count("*").alias("n"), F.min("pos").alias("primeiro"))


def elements_of(spark: SparkSession, directory: str) -> DataFrame:
    """Rows of the registry as elements of two overlapping answers of a map service."""
    rows = registry(spark, directory).filter(F.col("osm_id").isNotNull() & (F.col("osm_id") != ""))
    tags = F.map_from_arrays(F.array(F.lit("name"), F.lit("amenity"), F.lit("osm_id")), F.array(F.col("nome"), F.when(F.col("pos") % 2 == 0, "place_of_worship").otherwise("community_centre"), F.lit("tag")))
    element = rows.select(F.lit(0).alias("query"), F.col("pos").cast("int").alias("idx"), F.lit("node").alias("type"), F.col("osm_id").cast("bigint").alias("id"), "lat", F.col("lng").alias("lon"), tags.alias("tags"))
    return element.unionByName(element.withColumn("query", F.lit(1)))


def osm_feature_flatten(spark: SparkSession, directory: str) -> DataFrame:
    """Elements of all answers, each once, the first wins, named and with a point; tags flattened, the element's own id over a tag of its name."""
    flat = flattened_tags(named_elements(elements_of(spark, directory)))
    return flat.select("idx", "id", "lat", "lon", F.col("properties")["name"].alias("nome"), F.col("properties")["osm_id"].alias("osm_id"), F.col("properties")["osm_type"].alias("osm_type"))


def name_regex_source(spark: SparkSession, directory: str) -> DataFrame:
    """Elements whose name matches a pattern without case and whose tag has an exact value, as the remote filter would give them."""
    found = matching(elements_of(spark, directory).filter(F.col("query") == 0), {"name": "~terreiro|casa", "amenity": "place_of_worship"})
    return found.select("idx", "id")


def osm_dedupe_first(spark: SparkSession, directory: str) -> DataFrame:
    """How many elements came, and how many are left when each counts once."""
    every = elements_of(spark, directory)
    once = first_wins(every.withColumn("_order", F.struct("query", "idx")), ["type", "id"], "_order")
    return every.agg(F.count("*").alias("elementos")).crossJoin(once.agg(F.count("*").alias("unicos"), F.min("query").alias("consulta"), F.max("query").alias("ultima")))  # one row each


def pages(spark: SparkSession, directory: str) -> DataFrame:
    """Documents as archived pages, one file each part, read back whole."""
    path = scratch_path(spark)
    rows = table(spark, directory, "areas_referencia").select("area_id", F.concat(F.lit("<html><head><TITLE> "), F.coalesce("nome", F.lit("")), F.lit("\n area </TITLE></head><body><a href='a/"), "area_id", F.lit("'>x</a> <A class=y HREF=\"b/"), "tipo", F.lit("\">y</A></body></html>")).alias("value"))
    rows.select("value", "area_id").write.partitionBy("area_id").text(path)
    return html_pages(spark, f"{path}/*/*.txt").withColumn("area_id", F.regexp_extract("path", r"area_id=(\d+)", 1).cast("bigint"))


def html_title(spark: SparkSession, directory: str) -> DataFrame:
    return pages(spark, directory).select("area_id", "title")


def html_links(spark: SparkSession, directory: str) -> DataFrame:
    return pages(spark, directory).select("area_id", F.posexplode("links").alias("ordem", "link"))


QUERIES = {
    "primary_normalized": primary_normalized, "alias_features": alias_features, "metadata_merge": metadata_merge, "removed_names": removed_names, "removal_single_source": removal_single_source, "scan_stamp": scan_stamp,
    "suspects_ranked": suspects_ranked, "preview": preview, "rules_from_table": rules_from_table, "json_round_trip": json_round_trip, "array_round_trip": array_round_trip, "geojson_round_trip": geojson_round_trip,
    "csv_round_trip": csv_round_trip, "csv_export": csv_export, "queue_document": queue_document, "decision_store_round_trip": decision_store_round_trip, "optional_exclusions": optional_exclusions, "dataset_rewrite": dataset_rewrite,
    "osm_feature_flatten": osm_feature_flatten, "name_regex_source": name_regex_source, "osm_dedupe_first": osm_dedupe_first, "html_title": html_title, "html_links": html_links,
}

from cartoria.plans.registry import BOX, strip_sql  # noqa: E402
from cartoria.plans.review import SQL as REVIEW_SQL  # noqa: E402
from cartoria.plans.screening import SCAN, any_sql, label_sql  # noqa: E402

T_ALL = "terreiros_all_sources_v2"
REFINED = f"{SCAN}, rf AS (SELECT pos, nome, CASE WHEN {any_sql('nome', KEEP)} THEN 'manter' ELSE 'remover' END AS decisao FROM s WHERE bucket = 'ambiguous'), gone AS (SELECT nome FROM s WHERE bucket = 'suspect' UNION SELECT nome FROM rf WHERE decisao = 'remover')"
LEFT = f"{REFINED}, lf AS (SELECT * FROM {T_ALL} t WHERE NOT (coalesce(fonte = 'google', false) AND {strip_sql('t.nome')} IS NOT NULL AND {strip_sql('t.nome')} IN (SELECT nome FROM gone WHERE nome IS NOT NULL)))"
ELEMENTS = f"el AS (SELECT pos AS idx, osm_id::BIGINT AS id, lat, lng AS lon, nome, pos % 2 = 0 AS worship FROM {T_ALL} WHERE osm_id IS NOT NULL AND osm_id <> '')"

SQL = {
    "primary_normalized": f"SELECT pos, coalesce(ceao_id, '') AS ceao_id, 'ceao' AS fonte, 'CEAO' AS fonte_detalhe, CASE WHEN {BOX} THEN 'in_bahia' ELSE 'out_of_bahia' END AS geo_status, coalesce(ceao_id, '') AS id, false AS com_pagina FROM {T_ALL} WHERE fonte = 'ceao'",
    "alias_features": f"""SELECT pos, CASE WHEN pos % 3 = 2 THEN NULL ELSE nome END AS nome, fonte, CASE pos % 3 WHEN 1 THEN '' ELSE nacao END AS nacao, CASE pos % 3 WHEN 2 THEN '' ELSE endereco END AS endereco, municipio, 'in_bahia' AS geo_status, lat, lng FROM {T_ALL} WHERE {BOX}""",
    "metadata_merge": f"""WITH c AS (SELECT coalesce(fonte, 'desconhecida') AS fonte, count(*)::VARCHAR AS n, (count(*) FILTER ({BOX}))::VARCHAR AS m FROM {T_ALL} GROUP BY 1)
SELECT fonte, 'versao' AS chave, '2.1' AS valor FROM c UNION ALL SELECT fonte, 'coleta', 'manual' FROM c UNION ALL SELECT fonte, 'total', n FROM c UNION ALL SELECT fonte, 'mapeados', m FROM c""",
    "removed_names": f"WITH {REFINED} SELECT nome FROM gone",
    "removal_single_source": f"WITH {LEFT} SELECT pos, fonte, nome FROM lf",
    "scan_stamp": f"""WITH {LEFT} SELECT (SELECT count(*) FROM {T_ALL}) AS total_original, (SELECT count(*) FROM lf) AS total_limpo, (SELECT count(*) FROM {T_ALL}) - (SELECT count(*) FROM lf) AS total_removido,
  (SELECT count(*) FROM s WHERE bucket = 'suspect') AS google_fp_obvios, (SELECT count(*) FROM rf WHERE decisao = 'remover') AS google_fp_ambiguos, (SELECT count(*) FROM rf WHERE decisao = 'manter') AS google_mantidos_ambiguos, 'triagem por regras' AS metodo""",
    "suspects_ranked": f"WITH {SCAN} SELECT pos, razao, nome, row_number() OVER (ORDER BY razao, nome, pos) AS lugar FROM s WHERE bucket = 'suspect'",
    "preview": f"SELECT pos, nome FROM {T_ALL} WHERE {strip_sql('nome')} <> '' ORDER BY pos LIMIT 10",
    "rules_from_table": f"""WITH k AS (SELECT lower(municipio) AS label, min(pos) AS ord FROM {T_ALL} WHERE regexp_full_match(municipio, '[\\p{{L}} ]+') GROUP BY 1)
SELECT t.pos, (SELECT arg_min(k.label, k.ord) FROM k WHERE contains(lower(t.endereco), k.label)) AS rotulo FROM {T_ALL} t WHERE endereco IS NOT NULL""",
    "json_round_trip": f"SELECT row_number() OVER (ORDER BY pos) - 1 AS ordem, pos AS id, nome, fonte, rating FROM {T_ALL}",
    "array_round_trip": f"SELECT row_number() OVER (ORDER BY pos) - 1 AS ordem, osm_id, nome FROM {T_ALL} WHERE fonte = 'osm'",
    "geojson_round_trip": f"SELECT row_number() OVER (ORDER BY pos) - 1 AS ordem, pos AS id, nome, lat, lng FROM {T_ALL} WHERE {BOX}",
    "csv_round_trip": "SELECT coalesce(nome, '') AS nome, coalesce(latitude, '') AS latitude, coalesce(longitude, '') AS longitude, coalesce(motivo, '') AS motivo FROM exclusoes_curadas WHERE concat(coalesce(nome, ''), coalesce(latitude, ''), coalesce(longitude, ''), coalesce(motivo, '')) <> ''",
    "csv_export": f"SELECT coalesce(status_revisao, '') AS status_revisao, count(*) AS n, count(*) FILTER (motivo_decisao <> '') AS com_motivo, count(DISTINCT review_id) AS ids FROM ({REVIEW_SQL['decision_export']}) GROUP BY 1",
    "queue_document": f"SELECT lugar AS ordem, pos, lugar, sugestao, status_revisao, motivo_sugestao FROM ({REVIEW_SQL['review_queue_full']})",
    "decision_store_round_trip": REVIEW_SQL["decision_latest"],
    "optional_exclusions": f"SELECT count(*) AS registros FROM {T_ALL} WHERE nome IS NOT NULL",
    "dataset_rewrite": f"WITH {LEFT} SELECT coalesce(fonte, 'desconhecida') AS fonte, count(*) AS n, min(pos) AS primeiro FROM lf GROUP BY 1",
    "osm_feature_flatten": f"WITH {ELEMENTS}, n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY idx) AS k FROM el WHERE nome <> '') SELECT idx::INTEGER AS idx, id, lat, lon, nome, id::VARCHAR AS osm_id, 'node' AS osm_type FROM n WHERE k = 1 AND lat <> 0 AND lon <> 0 AND lat IS NOT NULL AND lon IS NOT NULL",
    "name_regex_source": f"WITH {ELEMENTS} SELECT idx::INTEGER AS idx, id FROM el WHERE worship AND regexp_matches(lower(nome), 'terreiro|casa')",
    "osm_dedupe_first": f"WITH {ELEMENTS} SELECT 2 * count(*) AS elementos, count(DISTINCT id) AS unicos, 0 AS consulta, 0 AS ultima FROM el",
    "html_title": "SELECT area_id, trim(coalesce(nome, '') || ' area') AS title FROM areas_referencia",
    "html_links": "SELECT area_id, 0 AS ordem, 'a/' || area_id AS link FROM areas_referencia UNION ALL SELECT area_id, 1, 'b/' || tipo FROM areas_referencia",
}
