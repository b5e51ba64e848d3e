"""Writing results as the single documents that people and maps read.

The executors write the lines of a document, sorted, as the compressed parts of a text; the driver only copies the parts one after another through a buffer, so a document of
any length passes, and removes them. A target is written beside its place and renamed, so that a reader sees the old document or the new one.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartoria.functions.lineage import ensure_checkpoint_dir, shuffles_removed


def version_dir(root: str, version: str) -> str:
    """A new folder for one version of the outputs; an existing one is never written over."""
    path = os.path.join(root, version)
    os.makedirs(path, exist_ok=False)
    return path


def _file(spark: SparkSession, path: str):  # noqa: ANN202 - JVM objects
    place = spark._jvm.org.apache.hadoop.fs.Path(path if ":" in path.split("/", 1)[0] else "file://" + os.path.abspath(path))
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _document(lines: DataFrame, path: str, head: str, tail: str) -> int:
    """Writes ``head``, the column ``line`` in the order of ``_o`` and ``tail``; the number of lines."""
    spark = lines.sparkSession
    parts = f"{ensure_checkpoint_dir(spark)}/cut-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        lines.orderBy("_o").select("line").write.text(parts, compression="gzip")
    target, files = _file(spark, path)
    files.mkdirs(target.getParent())
    beside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    source, shared = _file(spark, parts)
    out = files.create(beside)
    out.write(bytearray(head.encode("utf-8")))
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    for name in sorted(str(f.getPath()) for f in shared.listStatus(source)):
        if "/part-" in name:
            part, _ = _file(spark, name)
            stream = codecs.getCodec(part).createInputStream(shared.open(part))
            spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
            stream.close()
    out.write(bytearray(tail.encode("utf-8")))
    out.close()
    shared.delete(source, True)
    files.delete(target, False)
    files.rename(beside, target)
    return lines.count()


def _objects(df: DataFrame, order: str, pretty: bool = False) -> DataFrame:
    """``_o, line``: each row as JSON, nulls written, a comma before all but the first."""
    made = F.to_json(F.struct(*[c for c in df.columns if c != order]), {"ignoreNullFields": "false", "pretty": str(pretty).lower()})
    least = df.agg(F.min(order)).first()[0]
    return df.select(F.col(order).alias("_o"), F.concat(F.when(F.col(order) == F.lit(least), "").otherwise(","), made).alias("line"))


def write_json(df: DataFrame, path: str, order: str, metadata: dict | None = None, key: str = "registros", pretty: bool = False) -> int:
    """One document ``{metadata, key: [...]}`` in the given order, which must be unique; the number of records."""
    about = json.dumps(metadata or {}, ensure_ascii=False, indent=2 if pretty else None, separators=None if pretty else (",", ":"))
    return _document(_objects(df, order, pretty), path, '{"metadata":' + about + f',"{key}":[\n', "]}\n")


def write_geojson(df: DataFrame, path: str, order: str, lat: str = "lat", lng: str = "lng", pretty: bool = False) -> int:
    """A FeatureCollection of points, compact or indented; all other columns are properties."""
    properties = [c for c in df.columns if c not in (order, lat, lng)]
    feature = F.struct(
        F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(lng, lat).alias("coordinates")).alias("geometry"), F.struct(*properties).alias("properties")
    )
    rows = df.select(F.col(order), feature.alias("f")).select(order, "f.*")
    return _document(_objects(rows, order, pretty), path, '{"type":"FeatureCollection","features":[\n', "]}\n")


def csv_line(columns: list[Column]) -> Column:
    """A CSV line: fields with a comma, quote or line break are quoted, quotes doubled, nulls empty."""
    fields = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.concat_ws(",", *[F.when(f.rlike(r"[\",\r\n]"), F.concat(F.lit('"'), F.replace(f, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(f) for f in fields])


def write_csv(df: DataFrame, path: str, order: str, bom: bool = False) -> int:
    """A CSV with a header and \\n at line ends; with no rows just the header."""
    columns = [c for c in df.columns if c != order]
    lines = df.select(F.col(order).alias("_o"), csv_line([F.col(c) for c in columns]).alias("line"))
    return _document(lines, path, ("\ufeff" if bom else "") + ",".join(columns) + "\n", "")


def ranked_report(df: DataFrame, label: str, n: str, width: int = 70, top: int = 20) -> list[str]:
    """Numbered lines of a ranking, labels cut to a width: ``  1. label .... count``."""
    rows = df.orderBy(F.desc(n), label).limit(top)
    line = F.concat(F.rpad(F.substring(F.coalesce(F.col(label), F.lit("")), 1, width), width, " "), F.lpad(F.col(n).cast("string"), 8, " ")).alias("l")
    return [f"{i:>3}. {r['l']}" for i, r in enumerate(rows.select(line, n, label).orderBy(F.desc(n), label).collect(), 1)]
