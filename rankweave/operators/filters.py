"""Metadata filter language: a small expression tree, compiled to one Column."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal
from enum import Enum
from functools import reduce
from operator import and_, or_
from typing import Any, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.functions import metadata as md
from rankweave.functions.shredded import ShreddedLayout, shredded_keys


class FilterOperator(str, Enum):
    """Comparison of one metadata field with a value (fixed values)."""

    EQ = "=="
    NE = "!="
    GT = ">"
    GTE = ">="
    LT = "<"
    LTE = "<="
    IN = "in"
    NIN = "nin"
    ANY = "any"
    ALL = "all"
    CONTAINS = "contains"
    TEXT_MATCH = "text_match"
    TEXT_MATCH_INSENSITIVE = "text_match_insensitive"
    BETWEEN = "between"
    IS_EMPTY = "is_empty"
    EXISTS = "exists"


class FilterCondition(str, Enum):
    """How the members of a group are combined (fixed values)."""

    AND = "and"
    OR = "or"
    NOT = "not"


@dataclass(frozen=True)
class MetadataFilter:
    """One comparison."""

    key: str
    value: Any = None
    operator: FilterOperator = FilterOperator.EQ

    def to_dict(self) -> dict[str, Any]:
        return {"key": self.key, "value": self.value, "operator": self.operator.value}


@dataclass(frozen=True)
class MetadataFilters:
    """A group of comparisons and groups."""

    filters: tuple[Union[MetadataFilter, "MetadataFilters"], ...] | list
    condition: FilterCondition = FilterCondition.AND

    def to_dict(self) -> dict[str, Any]:
        members = [member.to_dict() for member in self.filters]
        return {"filters": members, "condition": self.condition.value}


Filter = Union[MetadataFilter, MetadataFilters]


def filter_from_dict(tree: Mapping[str, Any]) -> Filter:
    """Inverse of ``to_dict``: filters may live in a config file or a table."""
    if "filters" in tree:
        condition = FilterCondition(tree.get("condition", "and"))
        return MetadataFilters([filter_from_dict(t) for t in tree["filters"]], condition)
    return MetadataFilter(tree["key"], tree.get("value"), FilterOperator(tree.get("operator", "==")))


def _is_number(value: Any) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def _as_text(value: Any) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


@dataclass(frozen=True)
class _Field:
    """The field a leaf compares: a key of the JSON column, or a plain column."""

    key: str
    json: Column | None
    layout: ShreddedLayout | None = None

    def text(self) -> Column:
        if self.layout is not None:
            return self.layout.text(self.key)
        return F.col(self.key) if self.json is None else md.field_text(self.json, self.key)

    def number(self) -> Column:
        if self.layout is not None:
            return self.layout.number(self.key)
        return F.col(self.key) if self.json is None else md.field_number(self.json, self.key)

    def array(self) -> Column:
        if self.layout is not None:
            return self.layout.array(self.key)
        return F.col(self.key) if self.json is None else md.field_array(self.json, self.key)

    def against(self, values: list[Any]) -> tuple[Column, list[Any]]:
        """Field and values brought to one type: number when all are numbers."""
        if self.json is None:
            return F.col(self.key), values
        if values and all(_is_number(v) for v in values):
            if any(isinstance(v, int) and abs(v) >= 2**53 for v in values):
                # Beyond the whole numbers a double can tell apart.
                exact = self.text().try_cast("decimal(38,6)")
                return exact, [Decimal(v) for v in values]
            return self.number(), [float(v) for v in values]
        return self.text(), [_as_text(v) for v in values]

    def members(self, values: list[Any]) -> list[Any]:
        return values if self.json is None else [_as_text(v) for v in values]


def _list_of(leaf: MetadataFilter) -> list[Any]:
    if not isinstance(leaf.value, (list, tuple)):
        raise ValueError(f"operator {leaf.operator.value!r} needs a list of values")
    return list(leaf.value)


def _ordered(compare) -> Any:
    def build(field: _Field, leaf: MetadataFilter) -> Column:
        if leaf.value is None:
            return F.lit(None).cast("boolean")
        selector, (value,) = field.against([leaf.value])
        return compare(selector, F.lit(value))

    return build


def _in(field: _Field, leaf: MetadataFilter) -> Column:
    values = _list_of(leaf)
    if not values:
        return F.lit(False)
    selector, values = field.against(values)
    return selector.isin(values)


def _not_in(field: _Field, leaf: MetadataFilter) -> Column:
    values = _list_of(leaf)
    if not values:
        return F.lit(True)
    selector, values = field.against(values)
    return ~selector.isin(values)


def _any(field: _Field, leaf: MetadataFilter) -> Column:
    values = field.members(_list_of(leaf))
    if not values:
        return F.when(field.array().isNotNull(), False)
    return F.arrays_overlap(field.array(), F.array(*map(F.lit, values)))


def _all(field: _Field, leaf: MetadataFilter) -> Column:
    values = field.members(_list_of(leaf))
    if not values:
        return F.when(field.array().isNotNull(), True)
    return F.size(F.array_except(F.array(*map(F.lit, values)), field.array())) == 0


def _contains(field: _Field, leaf: MetadataFilter) -> Column:
    if leaf.value is None:
        return F.lit(None).cast("boolean")
    return F.array_contains(field.array(), F.lit(field.members([leaf.value])[0]))


def _pattern(compare) -> Any:
    def build(field: _Field, leaf: MetadataFilter) -> Column:
        if leaf.value is None:
            return F.lit(None).cast("boolean")
        return compare(field.text(), str(leaf.value))

    return build


def _between(field: _Field, leaf: MetadataFilter) -> Column:
    if not isinstance(leaf.value, (list, tuple)) or len(leaf.value) != 2:
        raise ValueError("operator 'between' needs a [low, high] pair")
    selector, (low, high) = field.against(list(leaf.value))
    return selector.between(F.lit(low), F.lit(high))


def _exists(field: _Field, leaf: MetadataFilter) -> Column:
    return field.text().isNotNull() if leaf.value else field.text().isNull()


def _is_empty(field: _Field, leaf: MetadataFilter) -> Column:
    empty = F.coalesce(field.text().cast("string"), F.lit("")) == ""
    return empty if leaf.value else ~empty


_LEAVES = {
    FilterOperator.EQ: _ordered(lambda a, b: a == b),
    FilterOperator.NE: _ordered(lambda a, b: a != b),
    FilterOperator.GT: _ordered(lambda a, b: a > b),
    FilterOperator.GTE: _ordered(lambda a, b: a >= b),
    FilterOperator.LT: _ordered(lambda a, b: a < b),
    FilterOperator.LTE: _ordered(lambda a, b: a <= b),
    FilterOperator.IN: _in,
    FilterOperator.NIN: _not_in,
    FilterOperator.ANY: _any,
    FilterOperator.ALL: _all,
    FilterOperator.CONTAINS: _contains,
    FilterOperator.TEXT_MATCH: _pattern(lambda text, p: text.like(p)),
    FilterOperator.TEXT_MATCH_INSENSITIVE: _pattern(lambda text, p: text.ilike(p)),
    FilterOperator.BETWEEN: _between,
    FilterOperator.EXISTS: _exists,
    FilterOperator.IS_EMPTY: _is_empty,
}


def _compile(node: Filter, json: Column | None, layout: ShreddedLayout | None = None) -> Column | None:
    if isinstance(node, MetadataFilter):
        build = _LEAVES.get(node.operator)
        if build is None:
            raise ValueError(f"unsupported operator: {node.operator!r}")
        return build(_Field(node.key, json, layout), node)
    parts = [part for part in (_compile(f, json, layout) for f in node.filters) if part is not None]
    if not parts:
        return None
    if node.condition is FilterCondition.OR:
        return reduce(or_, parts)
    both = reduce(and_, parts)
    return ~both if node.condition is FilterCondition.NOT else both


def compile_filter(
    node: Filter | None, metadata_column: str | None = "metadata", shredded: list[str] | None = None
) -> Column | None:
    """Boolean column of a filter; None when there is nothing to filter by.

    With ``metadata_column=None`` the keys are plain columns, and the
    predicates reach the Parquet scan. A comparison with a missing key is NULL:
    such a row is not selected, and not selected by the negation either.
    With ``shredded`` (the keys of a table written by ``write_shredded``)
    fields are read from their typed columns, or else from the parsed VARIANT;
    the text is not parsed again.
    """
    if node is None:
        return None
    layout = None if shredded is None or metadata_column is None else ShreddedLayout(metadata_column, shredded)
    return _compile(node, None if metadata_column is None else F.col(metadata_column), layout)


def apply_filter(
    df: DataFrame, node: Filter | Column | None, metadata_column: str | None = "metadata"
) -> DataFrame:
    """Rows that satisfy the filter. A ready Column is taken as it is."""
    if node is None:
        return df
    if isinstance(node, Column):
        return df.where(node)
    shredded = None if metadata_column is None else shredded_keys(df, metadata_column)
    predicate = compile_filter(node, metadata_column, shredded)
    return df if predicate is None else df.where(predicate)
