"""Metadata parsed once at write: VARIANT and shredded columns give the text filters' rows."""

import glob

import pyarrow.parquet as pq
import pytest

from checks.filters import CASES
from checks.tables import described
from rankweave.functions.shredded import discovered_keys, shredded_keys, write_shredded
from rankweave.operators.filters import FilterOperator as Op
from rankweave.operators.filters import MetadataFilter as M
from rankweave.operators.filters import MetadataFilters as G
from rankweave.operators.filters import apply_filter
from rankweave.runtime import scratch_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain(spark):
    return described(spark, SF).cache()


@pytest.mark.parametrize("keys", [None, [], ["lang", "tags", "n_chars"]])
def test_every_case_equals_the_text_filters(spark, plain, keys, rows):
    table = write_shredded(plain, scratch_path(spark, "shredded-test"), "metadata", keys)
    for name, (node, _) in CASES.items():
        want = rows(apply_filter(plain, node).select("id"))
        assert rows(apply_filter(table, node).select("id")) == want, name


def test_keys_are_found_and_kept(spark, plain):
    assert discovered_keys(plain) == sorted(["lang", "source", "n_chars", "quality", "toxic", "tags", "good", "note"])
    table = write_shredded(plain, scratch_path(spark, "shredded-test"), "metadata", ["lang", "n_chars"])
    assert shredded_keys(table) == ["lang", "n_chars"] and shredded_keys(plain) is None


def test_predicates_reach_the_scan_and_text_is_not_read(spark, plain):
    table = write_shredded(plain, scratch_path(spark, "shredded-test"), "metadata")
    node = G([M("lang", ["en", "de"], Op.IN), M("n_chars", [500, 5000], Op.BETWEEN), M("quality", True, Op.EXISTS)])
    plan = apply_filter(table, node).select("id")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(metadata__n__" in pushed and "In(metadata__t__" in pushed
    schema = plan[plan.index("ReadSchema") :].split("\n")[0]
    assert "metadata:" not in schema and "metadata__v" not in schema


def test_statistics_skip_row_groups(spark, plain):
    path = scratch_path(spark, "shredded-test")
    spark.conf.set("parquet.block.size", str(4096))
    try:
        write_shredded(plain.coalesce(1), path, "metadata", ["n_chars"], cluster=["n_chars"])
    finally:
        spark.conf.unset("parquet.block.size")
    groups = skipped = 0
    for name in glob.glob(f"{path.removeprefix('file:')}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index("metadata__n__0")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            groups += 1
            skipped += stats is not None and stats.has_min_max and stats.max < 2000
    assert groups > 1 and 0 < skipped < groups


def test_null_and_bad_metadata(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "not json"), (3, '{"a": null}'), (4, '{"a": 5, "b": [1, "x"]}')], "id long, metadata string")
    table = write_shredded(df, scratch_path(spark, "shredded-test"), "metadata", ["a"])
    for node in (M("a", 5), M("a", True, Op.EXISTS), M("a", False, Op.EXISTS), M("b", "x", Op.CONTAINS), M("b", True, Op.EXISTS)):
        assert rows(apply_filter(table, node).select("id")) == rows(apply_filter(df, node).select("id")), node
