"""JSON documents, GeoJSON, CSV and archived HTML as DataFrames with an explicit order.

The array under a key of a JSON document is read by all executors, however long it is: they count quotes and brackets chunk by chunk, the driver adds these up,
then each chunk is cut at the commas of the array. A document that is an array itself is read whole; what is large is written under a key, or as JSON lines or Parquet.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cartoria.functions.lineage import cut


def ordered(df: DataFrame, array: str, pos: str = "pos") -> DataFrame:
    """The elements of an array column as rows in their order: ``pos`` from 0 and the element's fields."""
    return df.select(F.posexplode(array).alias(pos, "_e")).select(pos, "_e.*")


def json_array(spark: SparkSession, path: str, schema: T.StructType, pos: str = "pos") -> DataFrame:
    """A JSON document that is an array of objects; ``pos`` is the index in it. Unknown keys are left out."""
    text = spark.read.text(path, wholetext=True)
    return ordered(text.select(F.from_json("value", T.ArrayType(schema)).alias("a")), "a", pos)


#: What a byte outside of strings adds to the depth of brackets.
STEP = np.zeros(256, dtype=np.int8)
STEP[list(b"{[")], STEP[list(b"}]")] = 1, -1
#: The name of a member before its value.
NAME = re.compile(rb'("(?:[^"\\]|\\.)*")\s*:\s*\Z', re.DOTALL)


def structure(body: bytes, quoted: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a piece of JSON, those in strings blanked but for the quotes, and their steps in depth; ``quoted`` is 1 if it begins within a string."""
    data = np.frombuffer(re.sub(rb"\\.", b"__", body, flags=re.DOTALL) if b"\\" in body else body, dtype=np.uint8)
    within = (np.cumsum(data == ord('"'), dtype=np.uint8) + np.uint8(quoted)) & 1 == 1
    data = np.where(within & (data != ord('"')), np.uint8(ord("_")), data)
    return data, STEP[data]


def document_chunks(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, seq, body, quotes, flat, inner``, written: documents in chunks that end with a ``}``, each with the parity of its quotes and its change in depth if it begins outside or within a string.

    A document that ends otherwise gets one ``}`` more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, seq = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            files, blocks = batch.column(0), batch.column(1)
            changes = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1])).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                here = (files[a].as_py(), blocks[a].as_py())
                place, seq = here, seq + 1 if here == place else 0
                body = b"}".join(batch.column(2)[a:b].cast(pa.binary()).to_pylist()) + b"}"
                data, flat = structure(body, 0)
                facts = (np.count_nonzero(data == ord('"')) & 1, int(flat.sum(dtype=np.int64)), int(structure(body, 1)[1].sum(dtype=np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*here, seq, body, *facts)], ["file", "block", "seq", "body", "quotes", "flat", "inner"])

    pieces = spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), "value")
    return cut(pieces.mapInArrow(run, "file string, block bigint, seq bigint, body binary, quotes bigint, flat bigint, inner bigint"))


def array_pieces(body: bytes, key: str, depth: int, quoted: int) -> tuple[list[tuple[bool, int, bool, bool, bytes]], bool | None]:
    """What a chunk that begins at this depth, perhaps within a string, has of the array under ``key``: pieces of elements, and whether that array is open at its end.

    A piece is (in the array or object that the chunk begins in; number of the element among those begun here, -1 if it began before; begun here; ended here; text).
    The second is None if all of the chunk is in what it begins in.
    """
    data, step = structure(body, quoted)
    level = depth + np.cumsum(step, dtype=np.int64)
    marks = np.flatnonzero(((step > 0) & (level == 2)) | ((step < 0) & (level == 1)) | ((data == ord(",")) & (level == 2)))
    pieces: list[tuple[bool, int, bool, bool, bytes]] = []
    begun_here = [0, 0]
    inherited = wanted = depth >= 2
    start, begun = 0, False

    def add(end: int | None) -> None:
        pieces.append((inherited, begun_here[inherited] if begun else -1, begun, end is not None, body[start:end]))
        begun_here[inherited] += begun

    for i in marks.tolist():
        if step[i] > 0:
            name = NAME.search(body[start:i])
            if name is None and quoted and depth == 1 and start == 0:
                raise ValueError("a name at the top of a document has a } in it")
            wanted, begun = bool(data[i] == ord("[") and name is not None and json.loads(name[1]) == key), True
        elif step[i] == 0:
            if wanted:
                add(i)
            begun = True
        else:
            if wanted and not (begun and not body[start:i].strip()):  # an empty array has no element
                add(i)
            inherited = wanted = False
        start = i + 1
    if wanted and (not len(level) or level[-1] >= 2):
        add(None)
    return pieces, None if inherited else wanted


def array_elements(spark: SparkSession, path: str, key: str) -> DataFrame:
    """``pos, text``: the elements of the array under ``key``, at the top of each document, as JSON; ``pos`` from 0."""
    chunks = document_chunks(spark, path)
    starts, place, depth, quoted = {}, None, 0, 0
    for c in [*sorted(chunks.drop("body").collect()), None]:  # one short row for each chunk
        if place is not None and (c is None or c["file"] != place) and (quoted or depth not in (0, -1)):
            raise ValueError(f"{place} is not a whole JSON document")
        if c is None:
            break
        if c["file"] != place:
            place, depth, quoted = c["file"], 0, 0
        starts[c["file"], c["block"], c["seq"]] = (depth, quoted)
        depth, quoted = depth + (c["inner"] if quoted else c["flat"]), quoted ^ c["quotes"]
    sent = spark.sparkContext.broadcast(starts)
    names = ["file", "block", "seq", "inherited", "n", "begun", "ended", "text", "left"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *chunk, body in zip(*[c.to_pylist() for c in batch.columns]):
                pieces, left = array_pieces(body, key, *sent.value[tuple(chunk)])
                rows = [(*chunk, *p, None) for p in pieces] + [(*chunk, None, None, None, None, None, left)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary(), pa.bool_()))], names)

    made = chunks.select("file", "block", "seq", "body").mapInArrow(run, "file string, block bigint, seq bigint, inherited boolean, n bigint, begun boolean, ended boolean, text binary, left boolean")
    pieces = cut(made)
    sent.destroy()  # the pieces are written
    begun = lambda inherited: F.count_if(F.col("begun") & (F.col("inherited") == inherited))
    told = pieces.groupBy("file", "block", "seq").agg(begun(True).alias("before"), begun(False).alias("here"), F.max("left").alias("left"))
    bases, place, total, within = [], None, 0, False
    for c in sorted(told.collect(), key=lambda c: (c["file"], c["block"], c["seq"])):
        if c["file"] != place:
            place, total, within = c["file"], 0, False
        before = c["before"] if within else 0
        bases.append((c["file"], c["block"], c["seq"], within, total, total + before))
        total += before + c["here"]
        within = within if c["left"] is None else c["left"]
    base = spark.createDataFrame(bases, "file string, block bigint, seq bigint, within boolean, first bigint, second bigint")
    found = pieces.filter(F.col("text").isNotNull()).join(F.broadcast(base), ["file", "block", "seq"]).filter(F.col("within") | ~F.col("inherited"))
    numbered = found.select("file", "block", "seq", (F.when(F.col("inherited"), F.col("first")).otherwise(F.col("second")) + F.col("n")).alias("pos"), (F.col("begun") & F.col("ended")).alias("whole"), F.col("text").cast("string").alias("text"))
    parts = numbered.filter(~F.col("whole")).groupBy("file", "pos").agg(F.array_sort(F.collect_list(F.struct("block", "seq", "text"))).alias("parts"))
    return numbered.filter("whole").select("pos", "text").unionByName(parts.select("pos", F.array_join("parts.text", "").alias("text")))


def json_path(spark: SparkSession, path: str, schema: T.StructType, key: str, pos: str = "pos") -> DataFrame:
    """The array under one key of a JSON document; one that is cut short raises."""
    return array_elements(spark, path, key).select(F.col("pos").alias(pos), F.from_json("text", schema).alias("_e")).select(pos, "_e.*")


def open_json_array(spark: SparkSession, path: str, pos: str = "pos") -> DataFrame:
    """``pos`` and ``fields``, a map of each object's top-level fields as text: absent keys stay absent, nulls stay null."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.posexplode(F.from_json("value", "array<map<string,string>>")).alias(pos, "fields"))


def geojson(spark: SparkSession, path: str, properties: T.StructType, pos: str = "pos") -> DataFrame:
    """The point features of a collection: ``pos``, ``lng``, ``lat`` and the properties."""
    feature = T.StructType([
        T.StructField("geometry", T.StructType([T.StructField("coordinates", T.ArrayType(T.DoubleType()))])),
        T.StructField("properties", properties),
    ])
    rows = json_path(spark, path, feature, "features", pos)
    return rows.select(pos, F.get("geometry.coordinates", F.lit(0)).alias("lng"), F.get("geometry.coordinates", F.lit(1)).alias("lat"), "properties.*")


def csv_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A CSV with a header, quotes doubled inside quotes, line breaks inside quotes and perhaps a byte-order mark.

    Short rows get '' where columns are missing; blank rows are skipped.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").option("mode", "PERMISSIVE")
    df = (reader.schema(schema) if schema else reader).csv(path)
    df = df.toDF(*[c.lstrip("﻿").strip('"') for c in df.columns])
    return df.na.fill("").filter(F.length(F.concat_ws("", *[F.col(c).cast("string") for c in df.columns])) > 0)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path of any file system that the session knows; a plain path is this machine's."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path if ":" in path.split("/", 1)[0] else "file://" + os.path.abspath(path))
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def optional_csv(spark: SparkSession, path: str | None, schema: T.StructType) -> DataFrame:
    """A CSV, or no rows of its schema where there is no path or no file."""
    if path is None or not exists(spark, path):
        return spark.createDataFrame([], schema)
    return csv_table(spark, path, schema)


def decision_store(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stored decisions, JSON lines; an unreadable or missing store is an empty one."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def html_pages(spark: SparkSession, path: str) -> DataFrame:
    """``path, title, links``: archived pages, read whole, with their title and the targets of their links."""
    pages = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
    return pages.select(
        "path",
        F.trim(F.regexp_replace(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " ")).alias("title"),
        F.regexp_extract_all("html", F.lit(r"(?is)<a\s[^>]*href\s*=\s*[\"']([^\"']+)[\"']"), F.lit(1)).alias("links"),
    )
