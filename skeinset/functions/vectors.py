"""Column expressions on vectors and mixed records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Features = str | Sequence[str]


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def coordinates(features: Features, size: int) -> list[str]:
    """One double per coordinate, as SQL text, from an array column or from a list of columns."""
    if isinstance(features, str):
        return [f"cast(`{features}`[{i}] as double)" for i in range(size)]
    if len(features) != size:
        raise ValueError(f"{len(features)} feature columns against vectors of size {size}")
    return [f"cast(`{f}` as double)" for f in features]


def as_vector(features: Features) -> Column:
    """The feature vector as one ``array<double>`` column."""
    if isinstance(features, str):
        return F.col(features).cast("array<double>")
    return F.array(*[F.col(f).cast("double") for f in features])


def squared_difference(x: Column | str, y: Column | str) -> Column:
    x, y = _col(x), _col(y)
    return (x - y) * (x - y)


def euclidean(a: Column | str, b: Column | str) -> Column:
    """Euclidean distance of two array columns of equal size."""
    parts = F.zip_with(_col(a), _col(b), squared_difference)
    return F.sqrt(F.aggregate(parts, F.lit(0.0), lambda s, v: s + v))


def minkowski(a: Column | str, b: Column | str, p: float = 2) -> Column:
    """Distance of order ``p``; 2 is the Euclidean one."""
    if p == 2:
        return euclidean(a, b)
    parts = F.zip_with(_col(a), _col(b), lambda x, y: F.pow(F.abs(x - y), F.lit(float(p))))
    return F.pow(F.aggregate(parts, F.lit(0.0), lambda s, v: s + v), F.lit(1.0 / p))


def midpoint(a: Column | str, b: Column | str) -> Column:
    """Half-way vector, without weights."""
    return F.zip_with(_col(a), _col(b), lambda x, y: (x + y) / F.lit(2.0))


def parse_vector(text: Column | str, sep: str = ",") -> Column:
    """Text to vector; text that is no number is an error."""
    return F.transform(F.split(_col(text), f"\\Q{sep}\\E"), lambda v: F.trim(v).cast("double"))


def format_vector(vector: Column | str, sep: str = ",") -> Column:
    return F.array_join(_col(vector).cast("array<string>"), sep)


def silhouette_score(a: Column | str, b: Column | str) -> Column:
    """``(b - a) / max(a, b)``, and 0 where both are 0."""
    a, b = _col(a), _col(b)
    top = F.greatest(a, b)
    return F.when(top == 0, F.lit(0.0)).otherwise((b - a) / top)


def min_max(x: Column | str, low: float, high: float) -> Column:
    """Scale so that ``low`` becomes 0 and ``high`` becomes 1."""
    return (_col(x).cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low))


def nominal_distance(x: Column | str, y: Column | str) -> Column:
    """0 for equal values, 1 for different ones."""
    return F.when(_col(x).eqNullSafe(_col(y)), F.lit(0.0)).otherwise(F.lit(1.0))


def mixed_distance(
    numeric: Sequence[tuple[Column, Column]], nominal: Sequence[tuple[Column, Column]]
) -> Column:
    """Squared differences of the numeric pairs plus nominal distances of the others, no root."""
    total = F.lit(0.0)
    for x, y in numeric:
        total = total + squared_difference(x, y)
    for x, y in nominal:
        total = total + nominal_distance(x, y)
    return total
