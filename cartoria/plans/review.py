"""The review queue: stable ids, suggestions, order, decisions and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartoria.functions.text import folded, html_escaped, stripped
from cartoria.functions.values import number, rounded, rounded_exact
from cartoria.operators.audit import percentage
from cartoria.operators.decisions import imported, latest_decisions, overlaid_queue, queue_filter, valid_imports, writable
from cartoria.operators.entities import clusters, linked_pairs, match_pairs, merged_entities
from cartoria.functions.lineage import cut
from cartoria.operators.keyed import globally_ranked, last_wins
from cartoria.operators.skew import small
from cartoria.sources.tables import table


# What a suggestion says where its list gives no reason.
REASONS = {"ambíguo": "Caso ambíguo da triagem automática", "possível falso positivo": "Possível falso positivo"}


def queue(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "revisao_google")


def stable_id(name: Column, lat: Column, lng: Column, source: str = "google") -> Column:
    """Sixteen hex digits of the SHA-256 of source, folded name and the point at six digits.

    The digits must be those of the exact binary value, which the JVM's rounding misses at decimal ties, hence the Arrow UDF.
    """
    text = F.concat_ws("|", F.lit(source), folded(stripped(F.coalesce(name, F.lit("")))), F.format_string("%.6f", rounded_exact(lat)), F.format_string("%.6f", rounded_exact(lng)))
    return F.substring(F.sha2(text, 256), 1, 16)


def review_id_hash(spark: SparkSession, directory: str) -> DataFrame:
    return queue(spark, directory).filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select("pos", stable_id(F.col("nome"), F.col("latitude"), F.col("longitude")).alias("id"))


def review_urls(spark: SparkSession, directory: str) -> DataFrame:
    """Links with an encoded point."""
    point = F.url_encode(F.concat_ws(",", F.col("latitude").cast("string"), F.col("longitude").cast("string")))
    rows = queue(spark, directory).filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return rows.select("pos", F.concat(F.lit("https://mapa.example/busca/?api=1&query="), point).alias("mapa"), F.concat(F.lit("https://mapa.example/rua?api=1&map_action=pano&viewpoint="), point).alias("rua"))


def suggestion(spark: SparkSession, directory: str) -> DataFrame:
    """Suggestions from earlier passes and the ledger's status, joined by the three-part key; the last entry of a key wins.

    A suggestion never becomes a decision: the status comes from the ledger alone.
    """
    rows = queue(spark, directory)
    key = [folded(stripped(F.coalesce("nome", F.lit("")))).alias("k"), rounded(F.col("latitude")).alias("a"), rounded(F.col("longitude")).alias("b")]
    earlier = rows.select(*key, "pos", "sugestao", "motivo_sugestao")
    ambiguous = last_wins(earlier.filter(F.col("sugestao") == "ambíguo").select("k", "a", "b", "pos", F.coalesce("motivo_sugestao", F.lit(REASONS["ambíguo"])).alias("m1")), ["k", "a", "b"], "pos").drop("pos")
    possible = last_wins(earlier.filter(F.col("sugestao") == "possível falso positivo").select("k", "a", "b", "pos", F.coalesce("motivo_sugestao", F.lit(REASONS["possível falso positivo"])).alias("m2")), ["k", "a", "b"], "pos").drop("pos")
    listed = table(spark, directory, "exclusoes_curadas").select(folded(stripped(F.coalesce("nome", F.lit("")))).alias("k"), rounded(number(F.col("latitude"))).alias("a"), rounded(number(F.col("longitude"))).alias("b"), F.coalesce("motivo", F.lit("")).alias("m3"))
    ledger = listed.groupBy("k", "a", "b").agg(F.max("m3").alias("m3"))
    joined = rows.select("pos", "nome", *key).join(ambiguous, ["k", "a", "b"], "left").join(possible, ["k", "a", "b"], "left").join(ledger, ["k", "a", "b"], "left")
    return joined.select(
        "pos", "nome",
        F.when(F.col("m1").isNotNull(), "ambíguo").when(F.col("m2").isNotNull(), "possível falso positivo").otherwise("sem sinal automático").alias("sugestao"),
        F.coalesce("m1", "m2", F.lit("")).alias("motivo_sugestao"),
        F.when(F.col("m3").isNotNull(), "falso_positivo").otherwise("pendente").alias("status_revisao"), F.coalesce("m3", F.lit("")).alias("motivo_decisao"),
    )


def queue_order() -> list[Column]:
    """Pending first, then by suggestion, then by name, stable by position."""
    priority = F.when(F.col("sugestao") == "ambíguo", 0).when(F.col("sugestao") == "possível falso positivo", 1).otherwise(2)
    return [(F.col("status_revisao") != "pendente").cast("int").asc(), priority.asc(), folded(F.coalesce("nome", F.lit(""))).asc(), F.col("pos").asc()]


def review_queue(spark: SparkSession, directory: str) -> DataFrame:
    return suggestion(spark, directory).select("pos", "sugestao", "motivo_sugestao", "status_revisao", "motivo_decisao")


def review_rank(spark: SparkSession, directory: str) -> DataFrame:
    """Each row's place and its neighbours among the rows of its status and suggestion, by name.

    All rows are ranked at once by (status, suggestion, name), so a status that all rows have is no single task; neighbours are found by place.
    """
    rows = queue(spark, directory).select("pos", "status_revisao", "sugestao", folded(F.coalesce("nome", F.lit(""))).alias("k"))
    ranked = cut(globally_ranked(rows, [F.col("status_revisao"), F.col("sugestao"), F.col("k"), F.col("pos")]).select("pos", "status_revisao", "sugestao", "rank"))
    first = ranked.groupBy("status_revisao", "sugestao").agg((F.min("rank") - 1).alias("before"), F.max("rank").alias("last"))  # a row for each pair of values
    group = (F.col("r.status_revisao").eqNullSafe(F.col("g.status_revisao"))) & (F.col("r.sugestao").eqNullSafe(F.col("g.sugestao")))
    placed = ranked.alias("r").join(small(first).alias("g"), group).select("pos", "rank", "before", "last")
    at = lambda name, shift: placed.select((F.col("rank") + shift).alias("rank"), F.col("pos").alias(name))
    around = placed.join(at("anterior", 1), "rank", "left").join(at("proximo", -1), "rank", "left")
    return around.select(
        "pos", (F.col("rank") - F.col("before")).alias("lugar"), F.when(F.col("rank") > F.col("before") + 1, F.col("anterior")).otherwise(-1).alias("anterior"), F.when(F.col("rank") < F.col("last"), F.col("proximo")).otherwise(-1).alias("proximo")
    )


def review_queue_full(spark: SparkSession, directory: str) -> DataFrame:
    """The queue as it is published, all eighteen columns, and the place of each row in its order: pending first, then by suggestion, then by name."""
    rows = queue(spark, directory).filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    told = lambda c: F.coalesce(c, F.lit("")).alias(c)
    base = rows.select(
        "pos", stable_id(F.col("nome"), F.col("latitude"), F.col("longitude")).alias("review_id"), F.lit("google").alias("fonte"), told("endereco"), told("bairro"), told("telefone"), "rating", "reviews",
        "latitude", "longitude", told("geo_status"), F.lit("").alias("observacoes"),
    )
    urls = review_urls(spark, directory).select("pos", F.col("mapa").alias("google_maps_url"), F.col("rua").alias("street_view_url"))
    made = base.join(suggestion(spark, directory).withColumn("nome", F.coalesce("nome", F.lit(""))), "pos").join(urls, "pos")
    return globally_ranked(made, queue_order(), "lugar")


def decision_write(spark: SparkSession, directory: str) -> DataFrame:
    """What a reviewer's decisions would write, by status."""
    made = writable(decision_log(spark, directory))
    return made.groupBy("status_revisao").agg(F.count("*").alias("n"), F.count_if(F.col("motivo_decisao") != "").alias("com_motivo"))


def decision_import(spark: SparkSession, directory: str) -> DataFrame:
    """The store after the whole log is imported into an empty one: by status and origin the decisions, and how many rows were imported for them."""
    log = decision_log(spark, directory).withColumn("ordem", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(log_order())]))
    known = queue(spark, directory)
    store = imported(log.limit(0), log, known, "review_id", "ordem")
    counts = valid_imports(log, known, "review_id").groupBy("status_revisao").agg(F.count("*").alias("importadas"))
    return store.groupBy("status_revisao", "origem").agg(F.count("*").alias("n")).join(counts, "status_revisao")


def decision_export(spark: SparkSession, directory: str) -> DataFrame:
    """The eleven columns of the export: each row of the queue with its decision laid over it."""
    return export_rows(spark, directory).drop("ordem")


def export_rows(spark: SparkSession, directory: str) -> DataFrame:
    latest = latest_decisions(decision_log(spark, directory), "review_id", log_order())
    rows = queue(spark, directory).withColumn("revisado_em", F.lit(None).cast("string"))
    over = overlaid_queue(rows, latest, "review_id", ["status_revisao", "motivo_decisao", "observacoes", "revisado_em"])
    return over.select(F.col("pos").alias("ordem"), *EXPORT)


# The columns of the export, in order.
EXPORT = ["review_id", "nome", "endereco", "fonte", "latitude", "longitude", "sugestao", "status_revisao", "motivo_decisao", "observacoes", "revisado_em"]


def review_summary(spark: SparkSession, directory: str) -> DataFrame:
    return queue(spark, directory).agg(
        F.count("*").alias("total"), F.count_distinct("review_id").alias("ids"), F.count_if(F.col("sugestao") == "ambíguo").alias("ambiguos"),
        F.count_if(F.col("sugestao") == "possível falso positivo").alias("possiveis"), F.count_if(F.col("status_revisao") == "falso_positivo").alias("excluidos"),
    )


LOG = ["review_id", "status_revisao", "motivo_decisao", "observacoes", "revisado_em", "recebido_em"]


def decision_log(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "decisoes_revisao").select(*LOG)


def log_order() -> list[Column]:
    return [F.coalesce("revisado_em", F.lit("")), F.col("recebido_em"), F.col("status_revisao"), F.coalesce("motivo_decisao", F.lit(""))]


def decision_latest(spark: SparkSession, directory: str) -> DataFrame:
    """The decision that holds for each id: the last one made, then the last received."""
    return latest_decisions(decision_log(spark, directory), "review_id", log_order()).select("review_id", "status_revisao", "motivo_decisao", "revisado_em")


def overlaid(spark: SparkSession, directory: str) -> DataFrame:
    latest = latest_decisions(decision_log(spark, directory), "review_id", log_order())
    return overlaid_queue(queue(spark, directory), latest, "review_id", ["status_revisao", "motivo_decisao"])


def decision_overlay(spark: SparkSession, directory: str) -> DataFrame:
    return overlaid(spark, directory).select("pos", "review_id", "status_revisao", "motivo_decisao", "decidido")


def decision_stats(spark: SparkSession, directory: str) -> DataFrame:
    """Progress of the review after the overlay."""
    done = F.count_if(F.col("status_revisao") != "pendente")
    return overlaid(spark, directory).agg(F.count("*").alias("total"), done.alias("revisados"), F.count_if(F.col("status_revisao") == "falso_positivo").alias("falsos"), F.count_if(F.col("status_revisao") == "pendente").alias("pendentes")).withColumn(
        "progresso", percentage(F.col("revisados"), F.col("total"))
    )


def queue_filter_query(spark: SparkSession, directory: str) -> DataFrame:
    return queue_filter(queue(spark, directory), "rua", "pendente", "ambíguo").select("pos", "nome")


def import_validate(spark: SparkSession, directory: str) -> DataFrame:
    valid = valid_imports(decision_log(spark, directory), queue(spark, directory), "review_id").withColumn("motivo_decisao", F.coalesce("motivo_decisao", F.lit("")))
    return valid.groupBy("status_revisao").agg(F.count("*").alias("n"), F.count_if(F.col("motivo_decisao") != "").alias("com_motivo"))


def html_escape(spark: SparkSession, directory: str) -> DataFrame:
    return queue(spark, directory).select("pos", html_escaped(F.concat(F.lit("<a title=\"'"), F.coalesce("nome", F.lit("")), F.lit("'\">&"))).alias("html"))


def entity_rows(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "terreiros_all_sources_v2")


def entity_match_pairs(spark: SparkSession, directory: str) -> DataFrame:
    """What ties records of different sources: points, names, distance and inclusion, by classes."""
    return match_pairs(entity_rows(spark, directory), max_abs_lat=85.0)


def entity_links(spark: SparkSession, directory: str) -> DataFrame:
    """Links between rows of different sources, unknown ones too, whose components are the entities."""
    return linked_pairs(entity_rows(spark, directory), max_abs_lat=85.0)


def entity_clusters(spark: SparkSession, directory: str) -> DataFrame:
    return clusters(entity_links(spark, directory))


def entity_survivor(spark: SparkSession, directory: str) -> DataFrame:
    """One record for each cluster or single record, its gaps filled from the others."""
    rows = entity_rows(spark, directory)
    labels = clusters(linked_pairs(rows, max_abs_lat=85.0))
    return merged_entities(rows, labels, ["nome", "endereco", "bairro", "municipio", "cep"])


QUERIES = {
    "review_id_hash": review_id_hash, "review_urls": review_urls, "review_queue": review_queue, "review_rank": review_rank, "review_queue_full": review_queue_full, "decision_write": decision_write, "decision_import": decision_import, "decision_export": decision_export, "review_summary": review_summary,
    "decision_latest": decision_latest, "decision_overlay": decision_overlay, "decision_stats": decision_stats, "queue_filter": queue_filter_query, "import_validate": import_validate,
    "html_escape": html_escape, "entity_match_pairs": entity_match_pairs, "entity_links": entity_links, "entity_clusters": entity_clusters, "entity_survivor": entity_survivor,
}

from cartoria.plans.registry import strip_sql  # noqa: E402

K = f"lower({strip_sql('coalesce(nome, chr(32))')})"
HOLDS = """h AS (SELECT review_id, max({a: coalesce(revisado_em, ''), b: recebido_em, c: status_revisao, d: coalesce(motivo_decisao, ''), m: motivo_decisao, r: revisado_em}) AS m FROM decisoes_revisao WHERE review_id IS NOT NULL GROUP BY 1)"""
OVER = f"""{HOLDS}, o AS (SELECT q.pos, q.review_id, coalesce(h.m.c, q.status_revisao) AS status_revisao, coalesce(h.m.m, q.motivo_decisao) AS motivo_decisao, h.review_id IS NOT NULL AS decidido FROM revisao_google q LEFT JOIN h USING (review_id))"""
DIST = "2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2)))) <= 50"
NORMAL = "trim(regexp_replace(translate(lower(nome), 'áàâãäéèêëíìîïóòôõöúùûüçñ', 'aaaaaeeeeiiiiooooouuuucn'), '[^\\p{L}\\p{N}]+', ' ', 'g'))"
ROWS = f"""e AS (SELECT *, nullif(fonte, '') AS f, {NORMAL} AS n, lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180 AS v FROM terreiros_all_sources_v2)"""
CLOSURE = f"""{ROWS},
x AS (SELECT a.pos AS a, b.pos AS b FROM e a JOIN e b ON b.lat BETWEEN a.lat - 0.00046 AND a.lat + 0.00046 WHERE a.v AND b.v AND a.f IS DISTINCT FROM b.f AND {DIST}
  UNION SELECT a.pos, b.pos FROM e a JOIN e b USING (n) WHERE n <> '' AND a.f IS DISTINCT FROM b.f
  UNION SELECT a.pos, b.pos FROM (SELECT s.n AS s, l.n AS l FROM (SELECT DISTINCT n FROM e WHERE length(n) > 5) s JOIN (SELECT DISTINCT n FROM e WHERE length(n) > 5) l ON length(l.n) > length(s.n) AND contains(l.n, s.n)) h
    JOIN e a ON a.n = h.s JOIN e b ON b.n = h.l WHERE a.f IS DISTINCT FROM b.f),
y AS (SELECT a, b FROM x UNION SELECT b, a FROM x), r AS (SELECT a AS p, b AS q FROM y UNION SELECT r.p, y.b FROM r JOIN y ON y.a = r.q), g AS (SELECT p AS pos, min(least(p, q)) AS grupo FROM r GROUP BY p)"""

SUGGESTED = f"""q AS (SELECT *, {K} AS k, round(latitude, 6) AS a, round(longitude, 6) AS b FROM revisao_google),
m1 AS (SELECT k, a, b, arg_max(coalesce(motivo_sugestao, 'Caso ambíguo da triagem automática'), pos) AS m FROM q WHERE sugestao = 'ambíguo' GROUP BY ALL), m2 AS (SELECT k, a, b, arg_max(coalesce(motivo_sugestao, 'Possível falso positivo'), pos) AS m FROM q WHERE sugestao = 'possível falso positivo' GROUP BY ALL),
m3 AS (SELECT {K} AS k, round(try_cast(latitude AS DOUBLE), 6) AS a, round(try_cast(longitude AS DOUBLE), 6) AS b, max(coalesce(motivo, '')) AS m FROM exclusoes_curadas GROUP BY 1, 2, 3)"""
SUGGEST = """SELECT pos, CASE WHEN m1.m IS NOT NULL THEN 'ambíguo' WHEN m2.m IS NOT NULL THEN 'possível falso positivo' ELSE 'sem sinal automático' END AS sugestao, coalesce(m1.m, m2.m, '') AS motivo_sugestao,
  CASE WHEN m3.m IS NOT NULL THEN 'falso_positivo' ELSE 'pendente' END AS status_revisao, coalesce(m3.m, '') AS motivo_decisao
FROM q LEFT JOIN m1 USING (k, a, b) LEFT JOIN m2 USING (k, a, b) LEFT JOIN m3 USING (k, a, b)"""

SQL = {
    "review_id_hash": f"SELECT pos, id FROM (SELECT *, substr(sha256('google|' || {K} || '|' || printf('%.6f', latitude) || '|' || printf('%.6f', longitude)), 1, 16) AS id FROM revisao_google) WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
    "review_urls": "SELECT pos, 'https://mapa.example/busca/?api=1&query=' || latitude::VARCHAR || '%2C' || longitude::VARCHAR AS mapa, 'https://mapa.example/rua?api=1&map_action=pano&viewpoint=' || latitude::VARCHAR || '%2C' || longitude::VARCHAR AS rua FROM revisao_google WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
    "review_queue": f"WITH {SUGGESTED} {SUGGEST}",
    "review_queue_full": f"""
WITH {SUGGESTED}, f AS ({SUGGEST}),
r AS (SELECT q.*, f.sugestao AS s, f.motivo_sugestao AS ms, f.status_revisao AS st, f.motivo_decisao AS md FROM q JOIN f USING (pos) WHERE latitude IS NOT NULL AND longitude IS NOT NULL)
SELECT pos, substr(sha256('google|' || {K} || '|' || printf('%.6f', latitude) || '|' || printf('%.6f', longitude)), 1, 16) AS review_id, 'google' AS fonte, coalesce(nome, '') AS nome, coalesce(endereco, '') AS endereco, coalesce(bairro, '') AS bairro,
  coalesce(telefone, '') AS telefone, rating, reviews, latitude, longitude, coalesce(geo_status, '') AS geo_status, s AS sugestao, ms AS motivo_sugestao, st AS status_revisao, md AS motivo_decisao, '' AS observacoes,
  'https://mapa.example/busca/?api=1&query=' || latitude::VARCHAR || '%2C' || longitude::VARCHAR AS google_maps_url, 'https://mapa.example/rua?api=1&map_action=pano&viewpoint=' || latitude::VARCHAR || '%2C' || longitude::VARCHAR AS street_view_url,
  row_number() OVER (ORDER BY (st <> 'pendente')::INT, CASE s WHEN 'ambíguo' THEN 0 WHEN 'possível falso positivo' THEN 1 ELSE 2 END, lower(coalesce(nome, '')), pos) AS lugar FROM r""",
    "review_rank": """
SELECT pos, row_number() OVER w AS lugar, coalesce(lag(pos) OVER w, -1) AS anterior, coalesce(lead(pos) OVER w, -1) AS proximo FROM revisao_google
WINDOW w AS (PARTITION BY status_revisao, sugestao ORDER BY lower(coalesce(nome, '')), pos)""",
    "review_summary": "SELECT count(*) AS total, count(DISTINCT review_id) AS ids, count(*) FILTER (sugestao = 'ambíguo') AS ambiguos, count(*) FILTER (sugestao = 'possível falso positivo') AS possiveis, count(*) FILTER (status_revisao = 'falso_positivo') AS excluidos FROM revisao_google",
    "decision_latest": f"WITH {HOLDS} SELECT review_id, m.c AS status_revisao, m.m AS motivo_decisao, m.r AS revisado_em FROM h",
    "decision_overlay": f"WITH {OVER} SELECT * FROM o",
    "decision_stats": f"""WITH {OVER} SELECT count(*) AS total, count(*) FILTER (status_revisao <> 'pendente') AS revisados, count(*) FILTER (status_revisao = 'falso_positivo') AS falsos, count(*) FILTER (status_revisao = 'pendente') AS pendentes,
  printf('%.1f%%', count(*) FILTER (status_revisao <> 'pendente') * 100.0::DOUBLE / greatest(count(*), 1)) AS progresso FROM o""",
    "queue_filter": "SELECT pos, nome FROM revisao_google WHERE contains(lower(concat_ws(' ', nome, endereco, bairro)), 'rua') AND status_revisao = 'pendente' AND sugestao = 'ambíguo'",
    "import_validate": """
WITH v AS (SELECT status_revisao, coalesce(motivo_decisao, '') AS m FROM decisoes_revisao WHERE review_id IN (SELECT review_id FROM revisao_google) AND status_revisao IN ('manter', 'falso_positivo', 'pendente'))
SELECT status_revisao, count(*) AS n, count(*) FILTER (m <> '') AS com_motivo FROM v GROUP BY 1""",
    "decision_write": f"""
WITH v AS (SELECT status_revisao, CASE WHEN status_revisao = 'falso_positivo' THEN coalesce({strip_sql('motivo_decisao')}, '') ELSE '' END AS m FROM decisoes_revisao WHERE status_revisao IN ('manter', 'falso_positivo', 'pendente'))
SELECT status_revisao, count(*) AS n, count(*) FILTER (m <> '') AS com_motivo FROM v WHERE status_revisao <> 'falso_positivo' OR m <> '' GROUP BY 1""",
    "decision_import": """
WITH v AS (SELECT * FROM decisoes_revisao WHERE review_id IN (SELECT review_id FROM revisao_google) AND status_revisao IN ('manter', 'falso_positivo', 'pendente')),
h AS (SELECT review_id, max({a: coalesce(revisado_em, ''), b: recebido_em, c: status_revisao, d: coalesce(motivo_decisao, '')}).c AS s FROM v GROUP BY 1)
SELECT s AS status_revisao, 'CSV importado' AS origem, count(*) AS n, (SELECT count(*) FROM v WHERE v.status_revisao = h.s) AS importadas FROM h GROUP BY s""",
    "decision_export": """
WITH h AS (SELECT review_id, max({a: coalesce(revisado_em, ''), b: recebido_em, c: status_revisao, d: coalesce(motivo_decisao, ''), m: motivo_decisao, o: observacoes, r: revisado_em}) AS m FROM decisoes_revisao WHERE review_id IS NOT NULL GROUP BY 1)
SELECT q.review_id, nome, endereco, fonte, latitude, longitude, sugestao, coalesce(h.m.c, status_revisao) AS status_revisao, coalesce(h.m.m, motivo_decisao) AS motivo_decisao, coalesce(h.m.o, observacoes) AS observacoes, h.m.r AS revisado_em
FROM revisao_google q LEFT JOIN h USING (review_id)""",
    "html_escape": """SELECT pos, replace(replace(replace(replace(replace('<a title="''' || coalesce(nome, '') || '''">&', '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;') AS html FROM revisao_google""",
    "entity_match_pairs": f"""
WITH {ROWS}, d AS (SELECT n, min(pos) AS h, count(DISTINCT coalesce(f, '?')) AS k, min(coalesce(f, '?')) AS f FROM e WHERE n <> '' GROUP BY n), w AS (SELECT lat, lng, min(pos) AS h, count(DISTINCT coalesce(f, '?')) AS k, min(coalesce(f, '?')) AS f FROM e WHERE v GROUP BY lat, lng)
SELECT w.h AS a, e.pos AS b, 'ponto' AS regra FROM e JOIN w USING (lat, lng) WHERE v AND k > 1 AND e.pos <> w.h UNION ALL SELECT d.h, e.pos, 'nome' FROM e JOIN d USING (n) WHERE k > 1 AND e.pos <> d.h
UNION ALL SELECT least(a.h, b.h), greatest(a.h, b.h), 'distancia' FROM w a JOIN w b ON b.lat BETWEEN a.lat AND a.lat + 0.00046 WHERE (b.lat > a.lat OR b.lng > a.lng) AND NOT (a.k = 1 AND b.k = 1 AND a.f = b.f) AND {DIST}
UNION ALL SELECT least(s.h, l.h), greatest(s.h, l.h), 'inclusao' FROM d s JOIN d l ON length(s.n) > 5 AND length(l.n) > length(s.n) AND contains(l.n, s.n) WHERE NOT (s.k = 1 AND l.k = 1 AND s.f = l.f)""",
    "entity_clusters": f"WITH RECURSIVE {CLOSURE} SELECT * FROM g",
    "entity_survivor": f"""
WITH RECURSIVE {CLOSURE}, c AS (SELECT e.*, coalesce(g.grupo, e.pos) AS grupo, (coalesce(nome, '') <> '')::INT + (coalesce(endereco, '') <> '')::INT + (coalesce(bairro, '') <> '')::INT + (coalesce(municipio, '') <> '')::INT + (coalesce(cep, '') <> '')::INT AS d FROM e LEFT JOIN g USING (pos))
SELECT grupo, count(*) AS registros, count(DISTINCT fonte) AS fontes_distintas, {', '.join(f"first({c} ORDER BY d DESC, pos) FILTER (coalesce({c}, '') <> '') AS {c}" for c in ("nome", "endereco", "bairro", "municipio", "cep"))} FROM c GROUP BY grupo""",
}
