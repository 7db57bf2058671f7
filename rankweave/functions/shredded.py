"""JSON metadata parsed once at write: a VARIANT column plus shredded typed columns.

Text metadata is parsed again by every filter leaf of every read. Here it is
parsed once, when the table is written:

- ``<column>__v``: the whole object as a VARIANT (``parse_json``), which
  later reads address by path without parsing text;
- for each shredded key, ``<column>__t__<n>`` (the field as text, as
  ``get_json_object`` gives it) and ``<column>__n__<n>`` (that text as a
  double), plain Parquet columns whose row-group statistics let the scan skip
  groups for pushed predicates. The key names are kept in the metadata of
  the VARIANT column, which the Parquet files keep.

Which keys to shred is given, or found by ``schema_of_variant_agg`` over all
rows (an aggregate added up per task). Keys that are not shredded are read
from the VARIANT column, so results never depend on the choice.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.functions import metadata as md

# Most keys given their own columns; the rest are read from the VARIANT.
MAX_SHREDDED = 32
_COMMENT = "rankweave.shredded"


def variant_name(column: str) -> str:
    return f"{column}__v"


def _slot(column: str, kind: str, position: int) -> str:
    return f"{column}__{kind}__{position}"


def _path(key: str) -> str:
    return "$['" + key.replace("'", "\\'") + "']"


def discovered_keys(df: DataFrame, column: str = "metadata", most: int = MAX_SHREDDED) -> list[str]:
    """Top-level keys of all objects, from the merged schema of all rows."""
    schema = df.select(F.schema_of_variant_agg(md.decode_typed(F.col(column))).alias("s")).first().s
    keys = re.findall(r"(?:^OBJECT<|, )([^:<>,]+):", schema or "")
    return sorted(dict.fromkeys(k.strip("`") for k in keys))[:most]


def shred(df: DataFrame, column: str = "metadata", keys: list[str] | None = None) -> DataFrame:
    """The table with its JSON column parsed once into a VARIANT and shredded columns.

    The text column stays as it is. A NULL or unparsable object reads as no
    keys, as the text filters read it.
    """
    keys = discovered_keys(df, column) if keys is None else list(keys)
    keys = [k for k in keys if not md._needs_map(k)][:MAX_SHREDDED]
    parsed = F.try_parse_json(F.col(column))
    out = df.withColumn(variant_name(column), parsed)
    slots = {}
    for i, key in enumerate(keys):
        text = md.field_text(F.col(column), key)
        slots[_slot(column, "t", i)] = text
        slots[_slot(column, "n", i)] = text.try_cast("double")
    out = out.withColumns(slots)
    return out.withMetadata(variant_name(column), {_COMMENT: json.dumps({"keys": keys})})


def shredded_keys(df: DataFrame, column: str = "metadata") -> list[str] | None:
    """Keys shredded in this table, in slot order; None when the column is not shredded."""
    name = variant_name(column)
    if name not in df.columns:
        return None
    note = df.schema[name].metadata.get(_COMMENT)
    return json.loads(note)["keys"] if note else []


def write_shredded(
    df: DataFrame, path: str, column: str = "metadata", keys: list[str] | None = None, cluster: list[str] | None = None
) -> DataFrame:
    """Write the shredded table and read it back.

    ``cluster`` keys sort the rows within each written file, so that the
    row groups of a file hold narrow ranges of those fields and their
    statistics prune. The key list travels in the Parquet schema's metadata.
    """
    out = shred(df, column, keys)
    if cluster:
        known = shredded_keys(out, column) or []
        slots = [known.index(k) for k in cluster if k in known]
        out = out.sortWithinPartitions(*[F.col(_slot(column, kind, i)) for i in slots for kind in ("n", "t")])
    out.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


class ShreddedLayout:
    """Where a field of a shredded table is read: its slot, else the VARIANT."""

    def __init__(self, column: str, keys: list[str]):
        self.column = column
        self.slots = {key: i for i, key in enumerate(keys)}
        self.variant = F.col(variant_name(column))

    def text(self, key: str) -> Column:
        if key in self.slots:
            return F.col(_slot(self.column, "t", self.slots[key]))
        if md._needs_map(key):
            return md.field_text(F.col(self.column), key)
        # VARIANT to text: strings bare, other values as JSON, JSON null as NULL.
        value = F.try_variant_get(self.variant, _path(key), "variant")
        bare = F.try_variant_get(value, "$", "string")
        plain = F.schema_of_variant(value).isin("STRING", "BIGINT", "INT", "SMALLINT", "TINYINT", "BOOLEAN")
        return F.when(F.is_variant_null(value) | value.isNull(), F.lit(None)).when(plain, bare).otherwise(F.to_json(value))

    def number(self, key: str) -> Column:
        if key in self.slots:
            return F.col(_slot(self.column, "n", self.slots[key]))
        return self.text(key).try_cast("double")

    def array(self, key: str) -> Column:
        if md._needs_map(key):
            return md.field_array(F.col(self.column), key)
        return F.try_variant_get(self.variant, _path(key), "array<string>")
