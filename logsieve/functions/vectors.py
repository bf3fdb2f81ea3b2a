"""Vector arithmetic on ``array<float>`` columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Similarities by name; larger is nearer for all three.
METRICS = ("cosine", "dot", "euclidean")


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0.0), lambda done, x: done + x)


def dot(left: Column, right: Column) -> Column:
    return _total(F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")))


def norm(vector: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(_total(F.transform(vector, lambda x: x.cast("double") * x.cast("double"))))


def unit(vector: Column) -> Column:
    """The vector scaled to length 1; null for a zero vector."""
    size = F.nullif(norm(vector), F.lit(0.0))
    return F.transform(vector, lambda x: x.cast("double") / size)


def distance(left: Column, right: Column) -> Column:
    """Euclidean distance."""
    squares = F.zip_with(left, right, lambda a, b: (a.cast("double") - b.cast("double"))
                         * (a.cast("double") - b.cast("double")))
    return F.sqrt(_total(squares))


def similarity(vector: Column, query: Column, metric: str = "cosine",
               query_norm: Column | None = None) -> Column:
    """Score of a vector against a query: larger is nearer. Null when it cannot be scored.

    Give ``query_norm`` when the query's length is known, so that it is not added up per row.
    """
    if metric == "dot":
        return dot(vector, query)
    if metric == "euclidean":
        return F.lit(0.0) - distance(vector, query)
    if metric == "cosine":
        lengths = norm(vector) * (norm(query) if query_norm is None else query_norm)
        return dot(vector, query) / F.nullif(lengths, F.lit(0.0))
    raise ValueError(f"metric must be one of {METRICS}, not {metric!r}")
