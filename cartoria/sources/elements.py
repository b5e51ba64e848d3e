"""Map elements over HTTP as a Python data source: one partition for each query, retried, never failing the job.

``spark.dataSource.register(ElementSource)`` and then
``spark.read.format("map_elements").option("endpoint", ...).option("query.0", ...).load()``.
"""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cartoria.operators.keyed import first_wins

SCHEMA = "query int, idx int, type string, id bigint, lat double, lon double, tags map<string,string>"


def area_query(area: str, tags: dict[str, str], kind: str = "node", timeout: int = 60) -> str:
    """A query in the service's language that leaves the filtering to it: elements of one kind in one area whose tags match.

    A value beginning with ``~`` is a pattern without case, any other is the exact value.
    """
    escaped = lambda v: v.replace("\\", "\\\\").replace('"', '\\"')
    tests = "".join(f'["{escaped(k)}"~"{escaped(v[1:])}",i]' if v.startswith("~") else f'["{escaped(k)}"="{escaped(v)}"]' for k, v in tags.items())
    return f'[out:json][timeout:{timeout}];area["ISO3166-2"="{escaped(area)}"]->.a;{kind}{tests}(area.a);out body;'


def matching(elements: DataFrame, tags: dict[str, str], kind: str = "node") -> DataFrame:
    """The same filter over elements that are already here, for sources that can't filter: kind, exact values, patterns, in lower case, without case."""
    kept = elements.filter(F.col("type") == kind)
    for key, value in tags.items():
        tag = F.try_element_at("tags", F.lit(key))
        kept = kept.filter(F.lower(tag).rlike(value[1:]) if value.startswith("~") else tag == value)
    return kept


class QueryPartition(InputPartition):
    def __init__(self, query: int, text: str):
        self.query, self.text = query, text


class ElementReader(DataSourceReader):
    """Options: ``endpoint`` (http, https or file; ``{query}`` in it is replaced by the query's number), ``query.N``, ``timeout``, ``attempts``, ``pause``."""

    def __init__(self, options: dict[str, str]):
        self.endpoint = options["endpoint"]
        self.timeout, self.attempts, self.pause = float(options.get("timeout", 60)), int(options.get("attempts", 3)), float(options.get("pause", 5))
        self.queries = {int(k.split(".", 1)[1]): v for k, v in options.items() if k.startswith("query.")}

    def partitions(self) -> list[QueryPartition]:
        return [QueryPartition(n, q) for n, q in sorted(self.queries.items())]

    def fetch(self, partition: QueryPartition) -> dict:
        url = self.endpoint.replace("{query}", str(partition.query))
        data = None if url.startswith("file:") else urllib.parse.urlencode({"data": partition.text}).encode()
        request = urllib.request.Request(url, data=data, headers={"User-Agent": "cartoria"})
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            return json.loads(answer.read().decode("utf-8"))

    def read(self, partition: QueryPartition) -> Iterator[tuple]:
        """The elements of one query; after the last failed attempt one row of type ``error`` tells why in its tags, and the others go on."""
        found: dict = {}
        why = ""
        for attempt in range(self.attempts):
            try:
                found = self.fetch(partition)
                break
            except (OSError, ValueError) as error:
                why = f"{type(error).__name__}: {error}"
                if attempt + 1 < self.attempts:
                    time.sleep(self.pause)
        else:
            yield partition.query, -1, "error", None, None, None, {"error": why, "attempts": str(self.attempts)}
        for i, e in enumerate(found.get("elements", [])):
            tags = {str(k): str(v) for k, v in (e.get("tags") or {}).items()}
            yield partition.query, i, e.get("type"), e.get("id"), e.get("lat"), e.get("lon"), tags


class ElementSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "map_elements"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ElementReader:  # noqa: ANN001
        return ElementReader(dict(self.options))


def failed_queries(elements: DataFrame) -> DataFrame:
    """``query, error, attempts`` of the queries that got no answer."""
    return elements.filter(F.col("type") == "error").select("query", F.col("tags")["error"].alias("error"), F.col("tags")["attempts"].cast("int").alias("attempts"))


def named_elements(elements: DataFrame) -> DataFrame:
    """Named elements with a point other than 0, each (type, id) once, the first of all queries."""
    named = elements.filter(F.nullif(F.try_element_at("tags", F.lit("name")), F.lit("")).isNotNull())
    once = first_wins(named.withColumn("_order", F.struct("query", "idx")), ["type", "id"], "_order").drop("_order")
    return once.filter((F.coalesce("lat", F.lit(0.0)) != 0) & (F.coalesce("lon", F.lit(0.0)) != 0))


def flattened_tags(elements: DataFrame) -> DataFrame:
    """Adds ``properties``: the tags, with the element's own id and type in place of tags of those names."""
    own = F.map_from_arrays(F.array(F.lit("osm_id"), F.lit("osm_type")), F.array(F.col("id").cast("string"), F.col("type")))
    others = F.map_filter(F.coalesce("tags", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))), lambda k, _: ~k.isin("osm_id", "osm_type"))
    return elements.withColumn("properties", F.map_concat(others, own))
