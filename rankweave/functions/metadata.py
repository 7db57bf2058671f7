"""JSON metadata: build, read, and pick single fields out of it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _path(key: str) -> str:
    return f"$['{key}']"


def _needs_map(key: str) -> bool:
    """Keys that a JSON path cannot name."""
    return not key or key == "*" or "'" in key or "?" in key


def encode(*columns: Column | str) -> Column:
    """JSON object from columns; NULL columns are left out."""
    return F.to_json(F.struct(*columns))


def decode(metadata: Column) -> Column:
    """JSON object as a map of text values; NULL becomes an empty map."""
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    return F.coalesce(F.from_json(metadata, "map<string,string>"), empty)


def decode_typed(metadata: Column) -> Column:
    """JSON object as a variant, values with their JSON types; NULL becomes an empty object."""
    return F.coalesce(F.try_parse_json(metadata), F.parse_json(F.lit("{}")))


def or_empty(metadata: Column) -> Column:
    return F.coalesce(metadata, F.lit("{}"))


def field_text(metadata: Column, key: str) -> Column:
    """Field as text. A missing key and a JSON null are both NULL."""
    if _needs_map(key):
        return F.try_element_at(F.from_json(metadata, "map<string,string>"), F.lit(key))
    return F.get_json_object(metadata, _path(key))


def field_number(metadata: Column, key: str) -> Column:
    """Field as a number; text that is no number gives NULL."""
    return field_text(metadata, key).try_cast("double")


def field_array(metadata: Column, key: str) -> Column:
    """Field as an array of text; NULL when it is not an array."""
    if _needs_map(key):
        return F.try_variant_get(F.try_parse_json(field_text(metadata, key)), "$", "array<string>")
    return F.try_variant_get(F.try_parse_json(metadata), _path(key), "array<string>")
