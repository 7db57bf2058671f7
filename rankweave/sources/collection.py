"""A stored collection: appended rows, of which the latest of an id counts.

Every change appends a folder ``rows/version=N`` with its own rows only: new
and replaced documents, or the ids that go. Readers take the row with the
highest version of each id. ``compact`` writes the current rows anew and lets
the older folders go. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.functions.embedders import Embedder, embed_documents
from rankweave.operators.filters import Filter, compile_filter
from rankweave.operators.rows import latest_rows, present_rows, rows_by_id, with_defaults
from rankweave.runtime import broadcast_if_small, folders, path_exists, remove_path
from rankweave.spec import CollectionSpec

_ID_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType()}


def _schema(spec: CollectionSpec, id_type: str) -> T.StructType:
    fields = [
        T.StructField(spec.id, _ID_TYPES[id_type]),
        T.StructField(spec.content, T.StringType()),
        T.StructField(spec.embedding, T.ArrayType(T.FloatType())),
    ]
    if spec.metadata:
        fields.append(T.StructField(spec.metadata, T.StringType()))
    return T.StructType(fields)


@dataclass(frozen=True)
class Collection:
    """Handle of a stored collection."""

    spark: SparkSession
    path: str
    spec: CollectionSpec
    dim: int
    id_type: str

    # -- reading ---------------------------------------------------------

    def _stored(self) -> DataFrame:
        """Every appended row, with its version and whether it is a deletion."""
        whole = _schema(self.spec, self.id_type).add("deleted", T.BooleanType()).add("version", T.LongType())
        return self.spark.read.schema(whole).parquet(f"{self.path}/rows")

    def versions(self) -> list[int]:
        """Numbers of the changes that are stored, from the names of their folders."""
        return sorted(int(n[8:]) for n in folders(self.spark, f"{self.path}/rows") if n.startswith("version="))

    def rows(self) -> DataFrame:
        """All documents as they are now.

        The oldest version holds each id once, so it is not shuffled: what later
        changes name is taken out of it, and their latest rows are added.
        """
        numbers, key, columns = self.versions(), self.spec.id, self.spec.columns()
        if not numbers:
            return self.spark.createDataFrame([], _schema(self.spec, self.id_type))
        stored = self._stored()
        base = stored.where((F.col("version") == numbers[0]) & ~F.col("deleted"))
        if len(numbers) == 1:
            return base.select(columns)
        newest = Window.partitionBy(key).orderBy(F.desc("version"))
        later = stored.where(F.col("version") > numbers[0])
        last = later.withColumn("_n", F.row_number().over(newest)).where("_n = 1 AND NOT deleted")
        named = broadcast_if_small(later.select(key).distinct(), F.octet_length(F.col(key).cast("string")))
        return base.join(named, key, "left_anti").select(columns).unionByName(last.select(columns))

    def _named(self, ids: DataFrame | Sequence[Any]) -> DataFrame:
        if isinstance(ids, DataFrame):
            return ids.select(self.spec.id)
        schema = T.StructType([T.StructField(self.spec.id, _ID_TYPES[self.id_type])])
        return self.spark.createDataFrame([(i,) for i in ids], schema)

    def get_by_ids(self, ids: DataFrame | Sequence[Any]) -> DataFrame:
        """Documents with these ids (id as text, content, metadata). Ids that
        do not exist are absent."""
        return present_rows(rows_by_id(self.rows(), self._named(ids), self.spec), self.spec)

    # -- changing --------------------------------------------------------

    def _append(self, rows: DataFrame) -> DataFrame:
        """Store rows as the next version; returns them as they were stored."""
        version = max(self.versions(), default=0) + 1
        path = f"{self.path}/rows/version={version}"
        rows.write.mode("overwrite").parquet(path)
        schema = _schema(self.spec, self.id_type).add("deleted", T.BooleanType())
        return self.spark.read.schema(schema).parquet(path)

    def upsert(self, docs: DataFrame, order: str | None = None) -> DataFrame:
        """Insert or replace rows by id; returns the ids as a DataFrame.

        A missing id becomes a random one, missing metadata ``{}``. Of rows
        with the same id the last counts: by ``order``, or by position. Only
        these rows are written.
        """
        spec = self.spec
        ordinal = F.monotonically_increasing_id() if order is None else F.col(order)
        vector = F.col(spec.embedding).cast("array<float>")
        fit = F.col(spec.content).isNotNull() & F.coalesce(F.size(vector) == self.dim, F.lit(False))
        refusal = f"every row needs content and an embedding of {self.dim} values"
        incoming = with_defaults(docs, spec).select(
            F.col(spec.id).cast(_ID_TYPES[self.id_type]).alias(spec.id),
            F.when(fit, F.col(spec.content)).otherwise(F.raise_error(F.lit(refusal)).cast("string")).alias(spec.content),
            vector.alias(spec.embedding),
            *([spec.metadata] if spec.metadata else []),
            ordinal.alias("_ordinal"),
        )
        last = latest_rows(incoming, "_ordinal", spec).withColumn("deleted", F.lit(False))
        try:
            return self._append(last).select(spec.id)
        except Exception as error:
            # The failed write has left no version behind.
            if refusal in str(error):
                remove_path(self.spark, f"{self.path}/rows/version={max(self.versions(), default=0) + 1}")
                raise ValueError(refusal) from error
            raise

    def add_texts(
        self, docs: DataFrame, embedder: Embedder, order: str | None = None, partitions: int | None = None
    ) -> DataFrame:
        """Embed the contents, then upsert. Positions are taken before rows are spread."""
        if order is None:
            docs, order = docs.withColumn("_place", F.monotonically_increasing_id()), "_place"
        embedded = embed_documents(docs, embedder, self.spec.content, self.spec.embedding, partitions)
        return self.upsert(embedded, order)

    def delete(
        self, ids: DataFrame | Sequence[Any] | None = None, filter: Filter | None = None
    ) -> bool:
        """Delete rows by id, by filter, or by both together.

        Stores the ids that go. False when nothing was asked for: no ids, and no
        filter or an empty one.
        """
        spec = self.spec
        predicate = compile_filter(filter, spec.metadata)
        given = None if ids is None or (not isinstance(ids, DataFrame) and not len(ids)) else self._named(ids)
        if given is None and predicate is None:
            return False
        gone = self.rows() if predicate is None else self.rows().where(predicate)
        if given is not None:
            gone = rows_by_id(gone, given, spec)
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in _schema(spec, self.id_type).fields[1:]]
        self._append(gone.select(spec.id, *empty, F.lit(True).alias("deleted")))
        return True

    def compact(self) -> int:
        """Write the current rows as one version and remove the older ones; no reader may be open.

        Returns how many versions went. Oldest first: a deletion outlives the
        rows it hides.
        """
        older = self.versions()
        if len(older) < 2:
            return 0
        self._append(self.rows().withColumn("deleted", F.lit(False)))
        for version in older:
            remove_path(self.spark, f"{self.path}/rows/version={version}")
        return len(older)

    def drop(self) -> None:
        drop_collection(self.spark, self.path)


_DEFINITION = "id string, content string, embedding string, metadata string, dim int, id_type string"


def create_collection(
    spark: SparkSession,
    path: str,
    dim: int,
    spec: CollectionSpec = CollectionSpec(),
    id_type: str = "string",
    overwrite: bool = False,
) -> Collection:
    """Create a collection if there is none; ``overwrite`` starts it anew."""
    if id_type not in _ID_TYPES:
        raise ValueError(f"id_type must be one of {sorted(_ID_TYPES)}")
    if overwrite:
        drop_collection(spark, path)
    if not path_exists(spark, f"{path}/definition"):
        row = (spec.id, spec.content, spec.embedding, spec.metadata, dim, id_type)
        spark.createDataFrame([row], _DEFINITION).coalesce(1).write.parquet(f"{path}/definition")
    return open_collection(spark, path)


def open_collection(spark: SparkSession, path: str) -> Collection:
    """Open a collection that exists."""
    if not path_exists(spark, f"{path}/definition"):
        raise ValueError(f"no collection at {path}")
    d = spark.read.schema(_DEFINITION).parquet(f"{path}/definition").first()
    spec = CollectionSpec(d["id"], d["content"], d["embedding"], d["metadata"])
    return Collection(spark, path, spec, d["dim"], d["id_type"])


def drop_collection(spark: SparkSession, path: str) -> None:
    remove_path(spark, path)


def validated(docs: DataFrame, spec: CollectionSpec = CollectionSpec()) -> DataFrame:
    """Use any table as a collection: check that the columns fit the spec.

    Id, content (text) and embedding (array of float or double) must exist. A
    missing metadata column is tolerated and reads as NULL.
    """
    types = {f.name: f.dataType for f in docs.schema.fields}
    for name in (spec.id, spec.content, spec.embedding):
        if name not in types:
            raise ValueError(f"column {name!r} does not exist")
    if not isinstance(types[spec.content], (T.StringType, T.VarcharType, T.CharType)):
        raise ValueError(f"column {spec.content!r} must be text")
    vector = types[spec.embedding]
    if not isinstance(vector, T.ArrayType) or not isinstance(vector.elementType, (T.FloatType, T.DoubleType)):
        raise ValueError(f"column {spec.embedding!r} must be an array of floats")
    if spec.metadata and spec.metadata not in types:
        docs = docs.withColumn(spec.metadata, F.lit(None).cast("string"))
    return docs


def build_collection(
    docs: DataFrame,
    path: str,
    dim: int,
    embedder: Embedder | None = None,
    spec: CollectionSpec = CollectionSpec(),
    order: str | None = None,
    partitions: int | None = None,
    **options: Any,
) -> Collection:
    """Create a collection and fill it in one call."""
    collection = create_collection(docs.sparkSession, path, dim, spec, **options)
    if embedder is None:
        collection.upsert(docs, order)
    else:
        collection.add_texts(docs, embedder, order, partitions)
    return collection
