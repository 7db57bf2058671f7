"""Registered queries: the metadata filter language."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.tables import described, table
from rankweave.functions.metadata import encode
from rankweave.operators.filters import (
    FilterCondition as C,
    FilterOperator as Op,
    MetadataFilter as M,
    MetadataFilters as G,
    apply_filter,
    filter_from_dict,
)

# name -> (filter over the collection's metadata, the same over plain columns)
CASES = {
    "filter_eq_text": (M("lang", "en"), "lang = 'en'"),
    "filter_eq_number": (M("quality", 1), "quality = 1"),
    "filter_eq_boolean": (M("good", True), "quality = 1"),
    "filter_eq_null": (M("lang", None), "FALSE"),
    "filter_ne": (M("quality", 1, Op.NE), "quality <> 1"),
    "filter_gt": (M("n_chars", 1000, Op.GT), "n_chars > 1000"),
    "filter_gte": (M("n_chars", 999.5, Op.GTE), "n_chars >= 999.5"),
    "filter_lt": (M("n_chars", 300, Op.LT), "n_chars < 300"),
    "filter_lte": (M("source", "src15", Op.LTE), "source <= 'src15'"),
    "filter_in_text": (M("lang", ["de", "fr"], Op.IN), "lang IN ('de', 'fr')"),
    "filter_in_number": (M("toxic", [1, 2], Op.IN), "toxic IN (1, 2)"),
    "filter_in_empty": (M("lang", [], Op.IN), "FALSE"),
    "filter_nin": (M("quality", [0], Op.NIN), "quality NOT IN (0)"),
    "filter_nin_empty": (M("quality", [], Op.NIN), "TRUE"),
    "filter_any": (M("tags", ["es", "src3"], Op.ANY), "lang = 'es' OR source = 'src3'"),
    "filter_all": (M("tags", ["en", "src3"], Op.ALL), "lang = 'en' AND source = 'src3'"),
    "filter_contains": (M("tags", "src7", Op.CONTAINS), "source = 'src7'"),
    "filter_text_match": (M("source", "src1_", Op.TEXT_MATCH), "source LIKE 'src1_'"),
    "filter_text_match_insensitive": (M("source", "SRC%9", Op.TEXT_MATCH_INSENSITIVE), "source ILIKE 'SRC%9'"),
    "filter_between_number": (M("n_chars", [400, 800], Op.BETWEEN), "n_chars BETWEEN 400 AND 800"),
    "filter_between_text": (M("source", ["src1", "src19"], Op.BETWEEN), "source BETWEEN 'src1' AND 'src19'"),
    "filter_exists": (M("quality", True, Op.EXISTS), "quality IS NOT NULL"),
    "filter_exists_not": (M("quality", False, Op.EXISTS), "quality IS NULL"),
    "filter_is_empty": (M("note", True, Op.IS_EMPTY), "lang = 'fr'"),
    "filter_is_empty_not": (M("note", None, Op.IS_EMPTY), "lang <> 'fr'"),
    "filter_number_on_text": (M("lang", 1, Op.GT), "FALSE"),
    "filter_and": (G([M("lang", "en"), M("n_chars", 500, Op.GTE)]), "lang = 'en' AND n_chars >= 500"),
    "filter_or": (G([M("lang", "es"), M("quality", 1)], C.OR), "lang = 'es' OR quality = 1"),
    "filter_not": (G([M("quality", 1), M("lang", "en")], C.NOT), "NOT (quality = 1 AND lang = 'en')"),
    "filter_nested": (
        G([G([M("lang", "en"), M("n_chars", 2000, Op.GTE)]), G([M("quality", 1)], C.NOT), G([])], C.OR),
        "(lang = 'en' AND n_chars >= 2000) OR NOT (quality = 1)",
    ),
    "filter_empty_group": (G([G([], C.NOT)]), "TRUE"),
    "filter_none": (None, "TRUE"),
}


def _documents(node):
    def run(spark, sf):
        # Filters travel through their dictionary form, as from a config file.
        tree = None if node is None else filter_from_dict(node.to_dict())
        return apply_filter(described(spark, sf), tree).select("id")

    return run


def _sql_documents(where: str) -> str:
    return f"""SELECT d.doc_id AS id FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE {where}"""


def event_props(spark, sf):
    """Stored JSON, filtered before an aggregate."""
    node = G([M("k", [20, 29], Op.BETWEEN), M("k", [25], Op.NIN)])
    kept = apply_filter(table(spark, sf, "events"), node, "props")
    return kept.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


def order_json(spark, sf):
    """JSON made of all columns of a large table."""
    orders = table(spark, sf, "orders")
    rows = orders.select("o_orderkey", "o_totalprice", encode("o_orderstatus", "o_orderpriority", "o_totalprice").alias("meta"))
    node = G([G([M("o_orderstatus", "F"), M("o_totalprice", 100000.0, Op.GT)]), M("o_orderpriority", "1-%", Op.TEXT_MATCH)], C.OR)
    kept = apply_filter(rows, node, "meta")
    return kept.agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def lineitem_columns(spark, sf):
    """Plain-column mode: the predicates reach the Parquet scan."""
    node = G([
        M("l_returnflag", ["A", "R"], Op.IN), M("l_quantity", [10.0, 20.0], Op.BETWEEN),
        M("l_discount", 0.05, Op.GTE), M("l_linestatus", "F"),
    ])
    kept = apply_filter(table(spark, sf, "lineitem"), node, None)
    return kept.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))


QUERIES = {name: _documents(node) for name, (node, _) in CASES.items()} | {
    "filter_event_props": event_props,
    "filter_order_json": order_json,
    "filter_lineitem_columns": lineitem_columns,
}

ORACLE = {name: _sql_documents(where) for name, (_, where) in CASES.items()} | {
    "filter_event_props": """SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events
      WHERE (props->>'k')::INTEGER BETWEEN 20 AND 29 AND (props->>'k')::INTEGER <> 25 GROUP BY event_type""",
    "filter_order_json": """SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
      WHERE (o_orderstatus = 'F' AND o_totalprice > 100000) OR o_orderpriority LIKE '1-%'""",
    "filter_lineitem_columns": """SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem
      WHERE l_returnflag IN ('A', 'R') AND l_quantity BETWEEN 10 AND 20 AND l_discount >= 0.05 AND l_linestatus = 'F'
      GROUP BY l_returnflag""",
}
