"""Registered queries: the filter language over metadata parsed once at write (VARIANT, shredded)."""

from __future__ import annotations

from checks.filters import CASES, _sql_documents
from checks.tables import described
from rankweave.functions.shredded import write_shredded
from rankweave.operators.filters import FilterCondition as C
from rankweave.operators.filters import FilterOperator as Op
from rankweave.operators.filters import MetadataFilter as M
from rankweave.operators.filters import MetadataFilters as G
from rankweave.operators.filters import apply_filter, filter_from_dict
from rankweave.runtime import scratch_path

# Half the keys get typed columns; the other half are read from the VARIANT.
HALF = ["lang", "n_chars", "quality", "source"]
PRUNED = G([
    M("lang", ["en", "de"], Op.IN), M("n_chars", [500, 5000], Op.BETWEEN), M("quality", True, Op.EXISTS),
    G([M("source", "src1%", Op.TEXT_MATCH), M("toxic", 0)], C.OR),
])


def _stored(spark, sf, keys, cluster=None):
    return write_shredded(described(spark, sf), scratch_path(spark, "shredded"), "metadata", keys, cluster)


def _case(node):
    def run(spark, sf):
        tree = None if node is None else filter_from_dict(node.to_dict())
        return apply_filter(_stored(spark, sf, HALF), tree).select("id")

    return run


def pruned(spark, sf):
    """Five leaves over all keys shredded, files clustered by length: pushed to the scan."""
    return apply_filter(_stored(spark, sf, None, ["n_chars"]), PRUNED).select("id")


QUERIES = {f"variant_{name}": _case(node) for name, (node, _) in CASES.items()} | {"filter_variant_pruned": pruned}

ORACLE = {f"variant_{name}": _sql_documents(where) for name, (_, where) in CASES.items()} | {
    "filter_variant_pruned": _sql_documents(
        "lang IN ('en', 'de') AND n_chars BETWEEN 500 AND 5000 AND quality IS NOT NULL AND (source LIKE 'src1%' OR toxic = 0)"
    ),
}
