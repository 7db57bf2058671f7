import gzip
import hashlib
import json
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rankweave.functions.embedders import batch_embedder, hash_embedder
from rankweave.functions.metadata import decode
from rankweave.functions.vectors import (
    cosine_similarity,
    hash_embedding,
    positional_hash_embedding,
)
from rankweave.operators.filters import FilterOperator, MetadataFilter, MetadataFilters
from rankweave.sources import corpora
from rankweave.sources.collection import (
    build_collection,
    create_collection,
    open_collection,
    validated,
)
from rankweave.spec import CollectionSpec
from rankweave.streaming.ingest import load_stream, stream_corpus

DOC = "id string, content string, embedding array<float>, metadata string"


def docs(spark, *items):
    return spark.createDataFrame([(i, c, [float(len(c)), 1.0], m) for i, c, m in items], DOC)


def contents(collection):
    return {r["id"]: r["content"] for r in collection.rows().collect()}


def test_insert_replace_delete(spark, tmp_path):
    made = create_collection(spark, str(tmp_path / "c"), 2)
    assert contents(made) == {} and made.get_by_ids(["a"]).count() == 0
    ids = made.upsert(docs(spark, ("a", "one", '{"k": 1}'), ("b", "two", None), ("c", "three", '{"k": 3}')))
    assert {r[0] for r in ids.collect()} == {"a", "b", "c"}
    made.upsert(docs(spark, ("b", "TWO", '{"k": 2}'), ("b", "last", '{"k": 2}'), ("d", "four", None)))
    assert contents(made) == {"a": "one", "b": "last", "c": "three", "d": "four"}
    again = open_collection(spark, str(tmp_path / "c"))
    found = {r["id"]: r["metadata"] for r in again.get_by_ids(["a", "d", "nope"]).collect()}
    assert found == {"a": '{"k": 1}', "d": "{}"}
    assert again.get_by_ids([]).count() == 0

    assert again.delete() is False and again.delete(ids=[]) is False
    assert again.delete(filter=MetadataFilters([])) is False
    assert again.delete(ids=["a", "d"], filter=MetadataFilter("k", 1)) is True
    assert set(contents(again)) == {"b", "c", "d"}
    assert again.delete(filter=MetadataFilter("k", 2, FilterOperator.NE)) is True
    assert set(contents(again)) == {"b", "d"}  # no key, no deletion
    assert again.delete(ids=["b", "d", "nope"]) is True
    assert contents(again) == {}
    again.upsert(docs(spark, ("e", "five", None)))
    assert contents(made) == {"e": "five"}
    again.drop()
    with pytest.raises(ValueError):
        open_collection(spark, str(tmp_path / "c"))


def test_upsert_is_idempotent_and_ordered(spark, tmp_path):
    made = create_collection(spark, str(tmp_path / "c"), 2)
    rows = docs(spark, ("a", "old", None), ("a", "newest", None), ("a", "older", None))
    rows = rows.withColumn("v", F.when(F.col("content") == "newest", 9).otherwise(1))
    for _ in range(2):
        made.upsert(rows, order="v")
        assert contents(made) == {"a": "newest"}


def test_a_change_writes_only_its_own_rows(spark, tmp_path):
    made = create_collection(spark, str(tmp_path / "c"), 2)
    made.upsert(docs(spark, *[(f"d{i}", "t", None) for i in range(60)]))
    made.upsert(docs(spark, ("d7", "changed", None)))
    made.delete(ids=["d8"])
    assert [spark.read.parquet(f"{tmp_path}/c/rows/version={v}").count() for v in (1, 2, 3)] == [60, 1, 1]
    assert len(contents(made)) == 59 and contents(made)["d7"] == "changed"
    assert made.compact() == 3 and made.compact() == 0
    assert len(contents(made)) == 59 and made.get_by_ids(["d7"]).first()["content"] == "changed"
    made.upsert(docs(spark, ("d8", "back", None)))
    assert contents(made)["d8"] == "back" and sorted(p.name for p in (tmp_path / "c").iterdir()) == ["definition", "rows"]


def test_the_last_row_of_an_id_counts_however_rows_are_spread(spark, tmp_path):
    texts = spark.createDataFrame([("a", f"v{i}") for i in range(40)], "id string, content string").coalesce(1)
    for parts in (None, 3, 4):
        made = build_collection(texts, str(tmp_path / f"c{parts}"), 4, hash_embedder(4), partitions=parts)
        assert contents(made) == {"a": "v39"}


def test_bad_rows_are_refused(spark, tmp_path):
    made = create_collection(spark, str(tmp_path / "c"), 2)
    for bad in ([("a", None, [1.0, 2.0], None)], [("a", "x", None, None)], [("a", "x", [1.0], None)]):
        with pytest.raises(ValueError):
            made.upsert(spark.createDataFrame(bad, DOC))
        assert made.versions() == []
    assert contents(made) == {}
    with pytest.raises(ValueError):
        create_collection(spark, str(tmp_path / "d"), 2, id_type="decimal")


def test_create_keeps_or_overwrites(spark, tmp_path):
    path, spec = str(tmp_path / "c"), CollectionSpec("key", "body", "vec", "meta")
    made = create_collection(spark, path, 2, spec, id_type="bigint")
    made.upsert(spark.createDataFrame([(5, "x", [1.0, 0.0])], "key long, body string, vec array<double>"))
    kept = create_collection(spark, path, 99)
    assert kept.dim == 2 and kept.spec == spec
    assert kept.get_by_ids([5]).first()["id"] == "5"
    assert create_collection(spark, path, 3, overwrite=True).rows().count() == 0


def test_texts_get_ids_and_vectors(spark, tmp_path):
    def model(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [float(len(t)), 2.0])

    texts = spark.createDataFrame([("ab",), ("abc",), ("ab",)], "content string")
    made = build_collection(texts, str(tmp_path / "c"), 2, batch_embedder(model))
    got = made.rows().collect()
    assert sorted((r["content"], list(r["embedding"]), r["metadata"]) for r in got) == [
        ("ab", [2.0, 2.0], "{}"), ("ab", [2.0, 2.0], "{}"), ("abc", [3.0, 2.0], "{}")]
    assert len({r["id"] for r in got}) == 3 and all(len(r["id"]) == 36 for r in got)


def test_any_table_can_be_checked(spark):
    table = docs(spark, ("a", "x", None))
    assert validated(table.drop("metadata")).first()["metadata"] is None
    for wrong in (table.drop("content"), table.withColumn("content", F.lit(1)), table.withColumn("embedding", F.lit("x"))):
        with pytest.raises(ValueError):
            validated(wrong)


def test_tsv_readers(spark, tmp_path, rows):
    topics = tmp_path / "topics.tsv"
    topics.write_text('1\tfirst "quoted" query\n2\tsecond\textra\nbroken line\n1\tfirst again\n\n', encoding="utf-8")
    assert rows(corpora.read_topics_tsv(spark, str(topics))) == [("1", "first again"), ("2", "second")]
    qrels = tmp_path / "qrels.tsv"
    qrels.write_text("1\t0\td1\t1\n1\t0\td1\t1\n1\t0\td2\t0\n1\t0\td3\t2\n2\t0\td4\n", encoding="utf-8")
    assert rows(corpora.read_qrels_tsv(spark, str(qrels))) == [("1", "d1")]
    assert rows(corpora.read_qrels_tsv(spark, str(qrels), graded=True)) == [("1", "d1"), ("1", "d3")]


def test_json_readers(spark, tmp_path, rows):
    for n in range(3):
        lines = [json.dumps({"docid": f"{n}-{i}", "title": "t", "text": "x" * i}) for i in range(2)]
        (tmp_path / f"docs-{n}.jsonl").write_text("\n".join(lines), encoding="utf-8")
    corpus = corpora.read_corpus_jsonl(spark, str(tmp_path / "docs-*.jsonl"))
    assert corpus.count() == 6 and corpora.read_corpus_jsonl(spark, str(tmp_path / "docs-*.jsonl")).count() == 6
    made = {r["id"]: (r["content"], json.loads(r["metadata"])) for r in corpora.corpus_to_documents(corpus).collect()}
    assert made["1-1"] == ("t\nx", {"docid": "1-1", "title": "t"})
    untitled = corpora.corpus_to_documents(corpora.read_corpus_jsonl(spark, str(tmp_path / "docs-0.jsonl"), titled=False), titled=False)
    assert {r["content"] for r in untitled.collect()} == {"", "x"}
    with gzip.open(tmp_path / "q.jsonl.gz", "wt", encoding="utf-8") as f:
        f.write(json.dumps({"query_id": "q1", "query": "what"}) + "\n")
    assert rows(corpora.read_queries_jsonl(spark, str(tmp_path / "q.jsonl.gz"))) == [("q1", "what")]


def test_content_is_whole_unless_cut_by_characters(spark):
    one = spark.createDataFrame([("d", "t", "😀" * 9000)], "docid string, title string, text string")
    whole = "t\n" + "😀" * 9000
    assert corpora.corpus_to_documents(one).first()["content"] == whole
    assert corpora.corpus_to_documents(one, max_chars=8000).first()["content"] == whole[:8000]


def test_stream_loads_a_folder_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    made = create_collection(spark, str(tmp_path / "c"), 8)

    def load():
        stream = stream_corpus(spark, str(folder), files_per_batch=1)
        load_stream(stream, made, hash_embedder(8), str(tmp_path / "offsets")).awaitTermination()

    for n in range(2):
        (folder / f"docs-{n}.jsonl").write_text(json.dumps({"docid": f"d{n}", "title": "t", "text": str(n)}) + "\n")
    load()
    assert contents(made) == {"d0": "t\n0", "d1": "t\n1"}
    (folder / "docs-9.jsonl").write_text(json.dumps({"docid": "d0", "title": "t", "text": "new"}) + "\n")
    load()
    assert contents(made) == {"d0": "t\nnew", "d1": "t\n1"}


@pytest.mark.parametrize("dim", [8, 32, 64, 100])
def test_hash_embeddings(spark, dim):
    texts = ["", "hello", "안녕하세요", "x" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", hash_embedding(F.col("t"), dim), positional_hash_embedding(F.col("t"), dim)).collect()
    for text, plain, moved in got:
        b = hashlib.sha256(text.encode()).digest()
        raw = [b[i % 32] / 255 * 2 - 1 for i in range(dim)]
        swung = [v * (0.5 + 0.5 * ((i + b[(i + 1) % 32]) % 100) / 100) for i, v in enumerate(raw)]
        for mine, want in ((plain, raw), (moved, swung)):
            norm = math.sqrt(sum(v * v for v in want))
            assert mine == pytest.approx([v / norm for v in want], abs=1e-6)


def test_small_expressions(spark):
    row = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0], None)], "a array<double>, z array<double>, m string").select(
        cosine_similarity(F.col("a"), F.col("a")), cosine_similarity(F.col("a"), F.col("z")), decode(F.col("m"))
    ).first()
    assert row[0] == 1.0 and row[1] is None and row[2] == {}
