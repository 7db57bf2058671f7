import json

import pytest
from pyspark.sql import functions as F

from rankweave.operators.filters import (
    FilterCondition as C,
    FilterOperator as Op,
    MetadataFilter as M,
    MetadataFilters as G,
    apply_filter,
    compile_filter,
    filter_from_dict,
)

# A shelf of instruments: family, body, strings, weight, in_tune.
SHELF = [
    ("plucked", "spruce", 6, 1.9, True), ("plucked", "maple", 12, 2.3, False), ("plucked", "carbon", 4, 2.0, True),
    ("bowed", "spruce", 4, 0.5, True), ("bowed", "maple", 4, 0.6, True), ("bowed", "maple", 4, 3.1, False),
    ("struck", "spruce", 230, 310.0, False), ("struck", "copper", 0, 48.5, True), ("blown", "silver", 0, 0.4, True),
    ("blown", "grenadilla", 0, 0.8, True), ("blown", "brass", 0, 1.1, False), ("blown", "brass", 0, 9.7, True),
]
FIELDS = ("family", "body", "strings", "weight", "in_tune")


@pytest.fixture(scope="module")
def shelf(spark):
    data = [(i, json.dumps(dict(zip(FIELDS, row)))) for i, row in enumerate(SHELF)]
    return spark.createDataFrame(data, "id int, metadata string").cache()


BLOWN = M("family", "blown")


@pytest.mark.parametrize(
    "node, keep",
    [
        (BLOWN, lambda f, b, s, w, t: f == "blown"),
        (M("family", "blown", Op.NE), lambda f, b, s, w, t: f != "blown"),
        (M("weight", 2.0, Op.GT), lambda f, b, s, w, t: w > 2.0),
        (M("weight", 2.0, Op.GTE), lambda f, b, s, w, t: w >= 2.0),
        (M("strings", 6, Op.LT), lambda f, b, s, w, t: s < 6),
        (M("strings", 6, Op.LTE), lambda f, b, s, w, t: s <= 6),
        (M("body", ["brass", "copper"], Op.IN), lambda f, b, s, w, t: b in ("brass", "copper")),
        (M("body", ["brass", "maple"], Op.NIN), lambda f, b, s, w, t: b not in ("brass", "maple")),
        (M("strings", [4, 12], Op.BETWEEN), lambda f, b, s, w, t: 4 <= s <= 12),
        (M("in_tune", True, Op.EXISTS), lambda f, b, s, w, t: True),
        (M("body", "%r%", Op.TEXT_MATCH), lambda f, b, s, w, t: "r" in b),
        (M("body", "S%", Op.TEXT_MATCH_INSENSITIVE), lambda f, b, s, w, t: b.startswith("s")),
        (M("body", "S%", Op.TEXT_MATCH), lambda f, b, s, w, t: False),
        (G([BLOWN, M("weight", 1, Op.GTE)]), lambda f, b, s, w, t: f == "blown" and w >= 1),
        (G([M("family", "bowed"), M("body", "copper")], C.OR), lambda f, b, s, w, t: f == "bowed" or b == "copper"),
        (G([BLOWN], C.NOT), lambda f, b, s, w, t: f != "blown"),
        (G([G([BLOWN, M("in_tune", True)]), M("strings", 100, Op.GT)], C.OR), lambda f, b, s, w, t: f == "blown" and t or s > 100),
        (M("family", "sampled"), lambda f, b, s, w, t: False),
        (M("in_tune", False), lambda f, b, s, w, t: not t),
        (M("in_tune", [True], Op.IN), lambda f, b, s, w, t: t),
        (M("strings", [0, 230], Op.IN), lambda f, b, s, w, t: s in (0, 230)),
    ],
)
def test_rows_that_stay(shelf, node, keep):
    want = [i for i, row in enumerate(SHELF) if keep(*row)]
    for same in (node, filter_from_dict(node.to_dict())):
        assert sorted(r["id"] for r in apply_filter(shelf, same).collect()) == want


EDGES = [
    (0, '{"a": "x", "n": 1, "tags": ["p", "q"]}'),
    (1, '{"a": null, "n": "7", "tags": []}'),
    (2, '{"a": "", "n": "abc", "tags": "p"}'),
    (3, '{"n": 2.5, "tags": [1, 2], "f.g": "dot", "it\'s": "quote", "who?": [5]}'),
    (4, None),
    (5, '{"big": 9007199254740993}'),
    (6, '{"*": "star"}'),
]


@pytest.mark.parametrize(
    "node, ids",
    [
        (M("a", "x", Op.NE), [2]),
        (M("a", None), []),
        (M("a", True, Op.EXISTS), [0, 2]),
        (M("a", False, Op.EXISTS), [1, 3, 4, 5, 6]),
        (M("a", True, Op.IS_EMPTY), [1, 2, 3, 4, 5, 6]),
        (M("a", None, Op.IS_EMPTY), [0]),
        (G([M("a", "x")], C.NOT), [2]),
        (M("a", [], Op.IN), []),
        (M("a", [], Op.NIN), [0, 1, 2, 3, 4, 5, 6]),
        (M("a", ["x"], Op.NIN), [2]),
        (M("n", 2, Op.GT), [1, 3]),
        (M("n", [1, 7], Op.IN), [0, 1]),
        (M("tags", ["q", "z"], Op.ANY), [0]),
        (M("tags", [], Op.ANY), []),
        (M("tags", ["p", "q"], Op.ALL), [0]),
        (M("tags", [], Op.ALL), [0, 1, 3]),
        (M("tags", [2], Op.ANY), [3]),
        (M("tags", "p", Op.CONTAINS), [0]),
        (M("tags", 1, Op.CONTAINS), [3]),
        (M("f.g", "dot"), [3]),
        (M("*", "star"), [6]),
        (M("*", True, Op.EXISTS), [6]),
        (M("it's", "quote"), [3]),
        (M("who?", "5", Op.CONTAINS), [3]),
        (M("big", 9007199254740993), [5]),
        (M("big", 9007199254740992), []),
        (G([G([], C.NOT), M("a", "x")]), [0]),
    ],
)
def test_missing_null_and_odd_values(spark, node, ids):
    df = spark.createDataFrame(EDGES, "id int, metadata string")
    assert sorted(r[0] for r in apply_filter(df, node).select("id").collect()) == ids


def test_malformed_filters_raise():
    for op in (Op.IN, Op.NIN, Op.ANY, Op.ALL):
        with pytest.raises(ValueError):
            compile_filter(M("a", "x", op))
    for value in ("x", [1], [1, 2, 3]):
        with pytest.raises(ValueError):
            compile_filter(M("a", value, Op.BETWEEN))
    with pytest.raises(ValueError):
        compile_filter(M("a", 1, "no such operator"))
    with pytest.raises(ValueError):
        filter_from_dict({"key": "a", "operator": "no such operator"})


def test_nothing_to_filter_by(shelf):
    assert compile_filter(None) is None
    assert compile_filter(G([])) is None
    assert apply_filter(shelf, G([G([])])).count() == len(SHELF)


def test_plain_columns_are_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", (F.col("id") % 7).alias("k")).write.parquet(path)
    kept = apply_filter(spark.read.parquet(path), G([M("k", [1, 2], Op.IN), M("id", 50, Op.GTE)]), None)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "In(k, [1,2])" in plan and "GreaterThanOrEqual(id,50)" in plan
    assert kept.count() == len([i for i in range(50, 100) if i % 7 in (1, 2)])
