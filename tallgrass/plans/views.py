"""Views over the given tables, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents pages labels conversations".split()

VIEWS = {
    "works_v": """
SELECT o_orderkey AS work_id, o_custkey AS owner, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'partial' ELSE 'pending' END AS status,
       o_orderdate AS updated_at, o_totalprice AS price FROM orders""",
    "work_history": """
SELECT o_custkey AS work_key, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS seq, o_orderpriority AS title,
       CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS author, CASE WHEN o_totalprice < 100000 THEN NULL ELSE o_orderkey END AS cover FROM orders""",
    "item_history": """
SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS seq,
       CASE WHEN l_linestatus = 'F' THEN 'completed' ELSE 'failed' END AS status, CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END AS publish_date,
       CASE WHEN l_tax = 0 THEN NULL ELSE l_suppkey END AS section_id FROM lineitem""",
    "section_history": """
SELECT l_orderkey AS work_id, l_returnflag AS title, l_linenumber AS vol_index, CASE WHEN l_tax = 0 THEN NULL ELSE l_suppkey END AS url_id,
       row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) AS seq FROM lineitem""",
    "asset_history": """
SELECT l_partkey AS asset_key, CASE WHEN l_tax = 0 THEN NULL ELSE l_orderkey END AS work_id, CASE WHEN l_discount = 0 THEN NULL ELSE l_linenumber END AS item_id,
       CASE WHEN l_returnflag = 'A' THEN 'cover' ELSE 'chapter_illustration' END AS asset_type, l_quantity AS quantity,
       row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS seq FROM lineitem""",
    "retry_actions": """
SELECT concat('/u', CAST(user_id AS STRING), '/', CAST(CAST(ts AS DATE) AS STRING)) AS target_url, event_id AS seq,
       CASE event_type WHEN 'click' THEN 'add' WHEN 'error' THEN 'fail' WHEN 'signup' THEN 'sync' WHEN 'purchase' THEN 'resolve' ELSE 'skip' END AS action FROM events""",
    "ledger_actions": """
SELECT CASE user_id % 3 WHEN 0 THEN 'work' WHEN 1 THEN 'item' ELSE 'image' END AS item_type, concat('/u', CAST(user_id AS STRING), '/', CAST(CAST(ts AS DATE) AS STRING)) AS target_url, event_id AS seq,
       CASE event_type WHEN 'click' THEN 'add' WHEN 'error' THEN 'fail' WHEN 'signup' THEN 'sync' WHEN 'purchase' THEN 'resolve' ELSE 'skip' END AS action, CASE WHEN event_type <> 'signup' AND event_id % 2 = 0 THEN user_id END AS target_id,
       CASE WHEN event_type = 'signup' THEN 3 ELSE 1 + event_id % 4 END AS max_attempts, CASE WHEN event_id % 5 <> 0 THEN concat('e', CAST(event_id AS STRING)) END AS error,
       CASE WHEN event_id % 7 = 0 THEN 'not json' WHEN event_id % 7 = 1 THEN NULL ELSE concat('{"novel_id":', CAST(user_id AS STRING), ',"chapter_index":', CAST(event_id % 50 AS STRING), ',"title":"t', CAST(event_id AS STRING), '","image_type":"cover"}') END AS extra FROM events""",
    "toc_items": """
SELECT conv_id AS work_id, turn AS item_index, CASE WHEN role = 'system' THEN NULL ELSE role END AS section, text FROM conversations""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql(spark: SparkSession, sf_dir: str, query: str) -> DataFrame:
    """Run a query over the given tables by name."""
    used = [t for t in TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", query)]
    return spark.sql(re.sub(r"\b(FROM|JOIN) (" + "|".join(TABLES) + r")\b", r"\1 {\2}", query.replace("{", "{{").replace("}", "}}")), **{t: table(spark, sf_dir, t) for t in used})


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return sql(spark, sf_dir, VIEWS[name])


def with_views(query: str) -> str:
    """Put the views that a query names before it."""
    used = [f"{n} AS ({q})" for n, q in VIEWS.items() if re.search(rf"\b{n}\b", query)]
    return f"WITH {', '.join(used)} {query}" if used else query
