"""Readers, sinks, the element source and the decision stream."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from cartoria.sources.documents import csv_table, decision_store, document_chunks, geojson, html_pages, json_array, json_path, open_json_array, optional_csv
from cartoria.sources.elements import ElementSource, area_query, failed_queries, flattened_tags, matching, named_elements
from cartoria.sources.sinks import ranked_report, version_dir, write_csv, write_geojson, write_json

NAME = T.StructType([T.StructField("nome", T.StringType()), T.StructField("lat", T.DoubleType())])


def test_json_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"nome": "b", "lat": 1.5, "x": 1}, {"nome": None}, {}]), encoding="utf-8")
    (tmp_path / "d.json").write_text(json.dumps({"metadata": {}, "terreiros": [{"nome": "é"}]}), encoding="utf-8")
    assert [(r["pos"], r["nome"], r["lat"]) for r in json_array(spark, str(tmp_path / "a.json"), NAME).orderBy("pos").collect()] == [(0, "b", 1.5), (1, None, None), (2, None, None)]
    assert json_path(spark, str(tmp_path / "d.json"), NAME, "terreiros").first()["nome"] == "é"
    fields = [r["fields"] for r in open_json_array(spark, str(tmp_path / "a.json")).orderBy("pos").collect()]
    assert "nome" in fields[1] and "nome" not in fields[2]


def test_long_documents_are_read_in_chunks(spark, tmp_path):
    """Elements whatever the layout, their strings and their neighbours hold, however the document is split; no task reads all of it."""
    names = [None if i % 7 == 0 else f'é{{"[}}],\\\\ "features": [{{{i}}}' * (i % 3) for i in range(200)]
    features = [{"geometry": {"coordinates": [[i, -i], [i]] if i % 5 == 0 else [i, -i]}, "properties": {"nome": n}} for i, n in enumerate(names)]
    document = {"a}b": "x}, {", "none": [], "before": [{"nome": "no"}] * 9, "m": {"features": [{"nome": "no"}], "t": "]}"}, "features": features, "empty": {}, "after": [[{"nome": "no"}]] * 9, "last": 1.5}
    feature = T.StructType([T.StructField("properties", NAME)])
    kept = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        for n, layout in enumerate(({"separators": (",", ":"), "ensure_ascii": False}, {"indent": 2})):
            path = str(tmp_path / f"{n}.json")
            with open(path, "w", encoding="utf-8") as f:
                json.dump(document, f, **layout)
            for size, batch in ((10_000, 3), (1 << 27, 10_000)) if n else ((4_000, 1),):
                for c, v in zip(kept, (size, 0, batch)):
                    spark.conf.set(c, v)
                rows = json_path(spark, path, feature, "features").orderBy("pos").collect()
                assert [(r["pos"], r["properties"]["nome"]) for r in rows] == list(enumerate(names))
        assert [r["nome"] for r in json_path(spark, path, NAME, "before").collect()] == ["no"] * 9
        assert not any(json_path(spark, path, NAME, key).count() for key in ("none", "empty", "m"))
        spark.conf.set("spark.sql.files.maxPartitionBytes", 4_000)
        chunks = document_chunks(spark, path)
        assert chunks.count() > 3 and chunks.agg(F.max(F.length("body"))).first()[0] < 9_000
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    (tmp_path / "short.json").write_text(json.dumps(document)[:-40])
    with pytest.raises(ValueError, match="not a whole JSON document"):
        json_path(spark, str(tmp_path / "short.json"), feature, "features")


def test_csv_edge_cases(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_bytes('﻿nome,motivo\r\n"a, ""b""","x\ny"\r\ncurta\r\n\r\n'.encode())
    rows = [(r["nome"], r["motivo"]) for r in csv_table(spark, str(path)).collect()]
    assert rows == [('a, "b"', "x\ny"), ("curta", "")]
    schema = T.StructType([T.StructField("nome", T.StringType())])
    assert optional_csv(spark, None, schema).count() == 0 and optional_csv(spark, str(tmp_path / "no.csv"), schema).count() == 0
    (tmp_path / "bad.json").write_text("{{{\n")
    assert decision_store(spark, str(tmp_path / "bad.json"), schema).count() == 0
    assert decision_store(spark, str(tmp_path / "no.json"), schema).count() == 0


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2, 'v "x"', -10.0, -40.0), (1, "a,b", -11.0, -41.0), (3, None, -12.0, -42.0)], "pos int, nome string, lat double, lng double")
    assert write_json(df, str(tmp_path / "o.json"), "pos", {"versao": "1"}) == 3
    document = json.loads((tmp_path / "o.json").read_text(encoding="utf-8"))
    assert [r["nome"] for r in document["registros"]] == ["a,b", 'v "x"', None] and "nome" in document["registros"][2]
    write_json(df, str(tmp_path / "p.json"), "pos", pretty=True)
    assert json.loads((tmp_path / "p.json").read_text(encoding="utf-8"))["registros"] == document["registros"]
    write_geojson(df, str(tmp_path / "g.json"), "pos")
    back = geojson(spark, str(tmp_path / "g.json"), T.StructType([T.StructField("nome", T.StringType())])).orderBy("pos").collect()
    assert [(r["lng"], r["lat"], r["nome"]) for r in back] == [(-41.0, -11.0, "a,b"), (-40.0, -10.0, 'v "x"'), (-42.0, -12.0, None)]
    write_csv(df.select("pos", "nome"), str(tmp_path / "o.csv"), "pos", bom=True)
    assert [r["nome"] for r in csv_table(spark, str(tmp_path / "o.csv")).collect()] == ["a,b", 'v "x"']
    assert write_csv(df.limit(0), str(tmp_path / "e.csv"), "pos") == 0 and (tmp_path / "e.csv").read_text() == "nome,lat,lng\n"
    version_dir(str(tmp_path), "v2")
    with pytest.raises(FileExistsError):
        version_dir(str(tmp_path), "v2")


def test_report(spark):
    lines = ranked_report(spark.createDataFrame([("b", 2), ("a", 2), ("x" * 90, 5)], "l string, n int"), "l", "n", width=10)
    assert lines[0].startswith("  1. xxxxxxxxxx") and lines[1].startswith("  2. a ")


def test_html(spark, tmp_path):
    (tmp_path / "p.html").write_text("<html><head><title> A\n b </title></head><a class=x href='u1'>1</a> <A HREF=\"u2\">2</A></html>")
    row = html_pages(spark, str(tmp_path / "p.html")).first()
    assert (row["title"], row["links"]) == ("A b", ["u1", "u2"])


def test_elements(spark, tmp_path):
    first = {"elements": [{"type": "node", "id": 1, "lat": -10.0, "lon": -40.0, "tags": {"name": "A", "osm_id": "z"}}, {"type": "node", "id": 2, "lat": 0, "lon": -40.0, "tags": {"name": "zero"}}, {"type": "node", "id": 3, "lat": 1.0, "lon": 1.0, "tags": {}}]}
    second = {"elements": [{"type": "node", "id": 1, "lat": -11.0, "lon": -40.0, "tags": {"name": "B"}}, {"type": "way", "id": 1, "lat": -11.0, "lon": -40.0, "tags": {"name": "C"}}]}
    for n, d in enumerate((first, second)):
        (tmp_path / f"q{n}.json").write_text(json.dumps(d))
    spark.dataSource.register(ElementSource)
    reader = spark.read.format("map_elements").option("endpoint", f"file://{tmp_path}/q{{query}}.json").option("pause", "0").option("attempts", "2")
    for n in range(3):  # the third query has no answer
        reader = reader.option(f"query.{n}", "node")
    elements = reader.load()
    assert elements.filter(F.col("type") != "error").count() == 5
    failed = failed_queries(elements).collect()
    assert [(r["query"], r["attempts"]) for r in failed] == [(2, 2)] and failed[0]["error"]
    kept = named_elements(elements)
    assert sorted((r["type"], r["id"], r["tags"]["name"]) for r in kept.collect()) == [("node", 1, "A"), ("way", 1, "C")]
    flat = flattened_tags(kept).filter(F.col("type") == "node").first()["properties"]
    assert flat == {"name": "A", "osm_id": "1", "osm_type": "node"}


def test_remote_filter(spark):
    text = area_query("BR-BA", {"amenity": "place_of_worship", "name": '~il[eê] "a"'})
    assert text == '[out:json][timeout:60];area["ISO3166-2"="BR-BA"]->.a;node["amenity"="place_of_worship"]["name"~"il[eê] \\"a\\"",i](area.a);out body;'
    rows = spark.sql("SELECT 'node' type, 1 id, map('name', 'ILÊ Axé', 'amenity', 'x') tags UNION ALL SELECT 'way', 2, map('name', 'ilê', 'amenity', 'x') UNION ALL SELECT 'node', 3, map('name', 'casa', 'amenity', 'x') UNION ALL SELECT 'node', 4, map('name', 'ilê') UNION ALL SELECT 'node', 5, NULL")
    assert [r["id"] for r in matching(rows, {"amenity": "x", "name": "~il[eê]"}).collect()] == [1]


def test_large_documents_are_streamed(spark, tmp_path):
    df = spark.range(20_000).select((F.lit(20_000) - F.col("id")).alias("pos"), F.concat(F.lit("linha\n\""), F.col("id")).alias("nome")).repartition(7)
    assert write_json(df, str(tmp_path / "sub" / "o.json"), "pos") == 20_000
    rows = json.loads((tmp_path / "sub" / "o.json").read_text())["registros"]
    assert len(rows) == 20_000 and rows[0]["nome"] == 'linha\n"19999'
    assert write_csv(df, str(tmp_path / "o.csv"), "pos") == 20_000 and csv_table(spark, str(tmp_path / "o.csv")).count() == 20_000


def test_stream(spark, tmp_path):
    from cartoria.streaming.decisions import latest_store, upsert_stream, windowed_counts

    schema = "id string, status_revisao string, t string, quando timestamp"
    source, store = tmp_path / "in", tmp_path / "store"
    spark.sql("SELECT '1' id, 'manter' status_revisao, 'a' t, timestamp'2026-01-01' quando").write.parquet(str(source / "1"))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(source))
    for n in (1, 2):
        query = upsert_stream(stream, str(store), "id", "t").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination(120)
        if n == 1:
            spark.sql("SELECT '1' id, 'falso_positivo' status_revisao, 'b' t, timestamp'2026-01-02' quando UNION ALL SELECT '2', 'manter', 'a', timestamp'2026-01-02'").write.parquet(str(source / "2"))
    assert {r["id"]: r["status_revisao"] for r in latest_store(spark, str(store)).collect()} == {"1": "falso_positivo", "2": "manter"}
    counts = windowed_counts(stream, "quando").writeStream.format("memory").queryName("janelas").outputMode("complete").start()
    counts.processAllAvailable()
    counts.stop()
    assert spark.sql("SELECT sum(n) FROM janelas").first()[0] == 3
