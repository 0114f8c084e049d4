"""Vector columns (``ARRAY<FLOAT|DOUBLE>``) for single pairs of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def dot(left: Column | str, right: Column | str) -> Column:
    products = F.zip_with(_col(left), _col(right), lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_norm(vector: Column | str) -> Column:
    return F.sqrt(
        F.aggregate(
            _col(vector), F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
        )
    )


def cosine(left: Column | str, right: Column | str) -> Column:
    """Cosine of two vectors; null where either has no length (never NaN)."""
    return F.try_divide(dot(left, right), l2_norm(left) * l2_norm(right))


def score_in(scores: Column | str, key: Column | str, default: float = 0.0) -> Column:
    """Entry of a ``MAP<id, score>``, ``default`` where the map or the entry is missing."""
    return F.coalesce(F.try_element_at(_col(scores), _col(key)), F.lit(default))
