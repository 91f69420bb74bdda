"""Reading and writing of tables, URL lists, documents and stored files."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, or where that is unset, under the warehouse; both are shared by all machines.

    A session with all its threads on one machine takes a folder of its own instead of the warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="spark-tallgrass-"))
        base = _own[0]
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir')}/tallgrass-scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, path: str, columns: Sequence[str], defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Chosen columns, with defaults for nulls; filters on others reach the scan."""
    df = spark.read.parquet(path).select(*columns)
    return df.fillna(dict(defaults)) if defaults else df


def read_url_list(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """URLs of a JSON array, or of lines: those that start with # and blank ones are dropped, others trimmed."""
    if kind == "json":
        return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<string>")).alias("url"))
    return spark.read.text(path).filter(~F.col("value").startswith("#")).select(F.trim("value").alias("url")).filter("url != ''")


def merge_url_lists(known: DataFrame, new: DataFrame) -> DataFrame:
    return known.select("url").union(new.select("url")).distinct().orderBy("url")


def as_json_list(urls: DataFrame) -> DataFrame:
    """The single-file form, for lists that fit a file."""
    return urls.agg(F.to_json(F.sort_array(F.collect_set("url"))).alias("value"))


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write a new version of a table below ``path`` and return where it is; versions being read are never touched."""
    version = f"{path.rstrip('/')}/v-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(version)
    return version


def export_text(documents: DataFrame, path: str, name: str = "file_name", content: str = "content", *, each: bool = False) -> None:
    """Documents by file name, sorted, many to a file as lines of JSON; with ``each``, a folder and a text file for every one.

    A folder for each document is for exports of a few thousand; more would be a burden to any store.
    """
    rows = documents.select(F.col(name).alias("file_name"), F.col(content).alias("content"))
    if each:
        rows.select("file_name", F.col("content").alias("value")).write.partitionBy("file_name").text(path)
    else:
        rows.repartitionByRange("file_name").sortWithinPartitions("file_name").write.json(path)


def read_export(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("file_name string, content string").json(path)


def asset_inventory(spark: SparkSession, path: str, *, least: int = 100) -> DataFrame:
    """Stored files over ``least`` bytes; the contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length").filter(F.col("length") > least)
