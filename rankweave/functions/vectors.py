"""Vector expressions: distances of paired vectors and the hash embedding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankweave.spec import DistanceStrategy



def _doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def inner_product(a: Column, b: Column) -> Column:
    return _total(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y))


def vector_norm(a: Column) -> Column:
    return F.sqrt(_total(F.transform(_doubles(a), lambda x: x * x)))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of two vectors; NULL when either has length zero."""
    return F.try_divide(inner_product(a, b), vector_norm(a) * vector_norm(b))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - cosine_similarity(a, b)


def l2_distance(a: Column, b: Column) -> Column:
    gaps = F.zip_with(_doubles(a), _doubles(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(_total(gaps))


def distance(a: Column, b: Column, metric: DistanceStrategy) -> Column:
    """Distance of two vectors in the same row, under the given metric."""
    if metric is DistanceStrategy.COSINE_DISTANCE:
        return cosine_distance(a, b)
    if metric is DistanceStrategy.EUCLIDEAN:
        return l2_distance(a, b)
    return inner_product(a, b)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once a row and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _byte(digest: Column, i: int) -> Column:
    return F.conv(F.substring(digest, 2 * i + 1, 2), 16, 10).cast("int")


def _scaled(values: Column, length: Column) -> Column:
    """Divide by the length; a zero vector stays as it is."""
    return F.when(length > 0, F.transform(values, lambda x: x / length)).otherwise(values)


def hash_embedding(text: Column, dim: int) -> Column:
    """Deterministic embedding of a text from its sha256 digest.

    The 32 digest bytes are mapped from [0, 255] to [-1, 1], repeated up to
    ``dim`` values and scaled to length one. It carries no meaning; it serves
    wherever a reproducible stand-in for a model is wanted.
    """
    rounds, rest = divmod(dim, 32)

    def squares(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x * x)

    def unit(values: Column) -> Column:
        total = squares(values) * rounds + squares(F.slice(values, 1, rest))
        return _let(F.sqrt(total), lambda length: _scaled(values, length))

    def repeated(values: Column) -> Column:
        return F.slice(F.flatten(F.array_repeat(values, rounds + 1)), 1, dim)

    def values(digest: Column) -> Column:
        return F.array(*[_byte(digest, i) / F.lit(255.0) * 2 - 1 for i in range(32)])

    built = _let(F.sha2(text, 256), lambda digest: _let(values(digest), unit))
    return repeated(built.cast("array<float>"))


def positional_hash_embedding(text: Column, dim: int) -> Column:
    """Hash embedding whose values also depend on their position."""

    def swung(numbers: Column) -> Column:
        def value(i: Column) -> Column:
            here, after = F.get(numbers, i % 32), F.get(numbers, (i + 1) % 32)
            swing = F.lit(0.5) + F.lit(0.5) * ((i + after) % 100) / 100
            return (here / F.lit(255.0) * 2 - 1) * swing

        return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), value)

    def unit(values: Column) -> Column:
        return _let(vector_norm(values), lambda length: _scaled(values, length))

    built = _let(
        F.sha2(text, 256),
        lambda digest: _let(
            F.array(*[_byte(digest, i) for i in range(32)]), lambda numbers: _let(swung(numbers), unit)
        ),
    )
    return built.cast("array<float>")
