"""Paged feeds, runs and settings."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from urllib.parse import urlencode

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

RUN_ID = r"^\d{8}-\d{6}$"


def page_url(base: str, key: str, category: str, index: int, unit: int = 100) -> str:
    """The address of one page."""
    asked = {"crtfcKey": key, "dataType": "json", "searchLclasId": category, "pageUnit": unit, "pageIndex": index}
    return f"{base}?{urlencode(asked)}"


def items_of(payload: object) -> list:
    """What a response holds; anything but a list counts as empty."""
    if not isinstance(payload, dict):
        return []
    found = payload.get("jsonArray")
    found = payload.get("items") if found is None else found
    return found if isinstance(found, list) else []


def all_pages(fetch: Callable[[int], object], unit: int = 100) -> Iterator[list]:
    """Pages until one is empty or short."""
    index = 1
    while True:
        items = items_of(fetch(index))
        if items:
            yield items
        if len(items) < unit:
            return
        index += 1


class PagedFeed(DataSource):
    """Pages of categories, one partition a category; ``root`` holds <category>/<index>.json as they were fetched."""

    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> str:
        return "category string, item string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _FeedReader(self.options)


class _Category(InputPartition):
    def __init__(self, name: str) -> None:
        super().__init__(name)
        self.name = name


class _FeedReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.root, self.unit = options["root"], int(options.get("pageunit", options.get("pageUnit", "100")))
        self.categories = [c for c in options["categories"].split(",") if c]

    def partitions(self) -> list[_Category]:
        return [_Category(c) for c in self.categories]

    def read(self, partition: _Category) -> Iterator[tuple]:
        def fetch(index: int) -> object:
            path = os.path.join(self.root, partition.name, f"{index}.json")
            if not os.path.exists(path):
                return {}
            with open(path, encoding="utf-8") as f:
                return json.load(f)

        for page in all_pages(fetch, self.unit):
            for item in page:
                yield partition.name, json.dumps(item, ensure_ascii=False, sort_keys=True)


def settings(text: str, needed: tuple[str, ...] = ()) -> dict[str, str]:
    """Lines of key=value; blank lines and comments are skipped, a needed key that is missing is an error."""
    out = {}
    for line in text.splitlines():
        line = line.strip()
        if line and not line.startswith("#") and "=" in line:
            key, _, value = line.partition("=")
            out[key.strip()] = value.strip()
    for key in needed:
        if not out.get(key):
            raise KeyError(f"{key} is not set")
    return out


def newest_run(runs: DataFrame, column: str = "run_id") -> DataFrame:
    """The newest run by its name; other names are no runs."""
    return runs.where(F.rlike(column, F.lit(RUN_ID))).agg(F.max(column).alias(column))


def of_newest_run(rows: DataFrame, column: str = "run_id", variable: str = "SPARROWMILL_RUN") -> DataFrame:
    """Rows of the newest run, or of the one that an environment variable of the driver names."""
    if named := os.environ.get(variable):
        return rows.where(F.col(column) == named)
    return rows.join(F.broadcast(newest_run(rows.select(column), column)), column, "left_semi")


def json_items(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one JSON array, as rows."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, all strings; a byte order mark is no part of the first name."""
    df = spark.read.option("header", True).csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def attachment_pairs(names: str, urls: str):
    """Files named and addressed in two lists joined by @: one for each address, with a name of its own where it lacks one."""
    clean = lambda c: F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), "@"), lambda x: F.trim(x)), lambda x: x != "")
    own = lambda i: F.format_string("attachment-%02d", i + 1)
    return F.transform(clean(urls), lambda u, i: F.struct(F.coalesce(F.get(clean(names), i), own(i)).alias("name"), u.alias("url")))
