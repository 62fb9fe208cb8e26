"""Numeric expressions that are safe under ANSI rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(n: Column, d: Column) -> Column:
    """n / d, null unless d > 0."""
    return F.when(d > 0, n / d)


def logit(p: Column, edge: float = 1e-6) -> Column:
    q = F.least(F.greatest(p, F.lit(edge)), F.lit(1 - edge))
    return F.ln(q / (1 - q))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def idf(total: Column, df: Column) -> Column:
    return F.ln(total.cast("double")) - F.ln(df.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return safe_div(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def f_score(tp: Column, n_gt: Column, n_pred: Column) -> Column:
    """F with beta 0.5; with nothing to find it is 1 exactly if nothing was predicted."""
    return F.when(n_gt == 0, (n_pred == 0).cast("double")).otherwise(1.25 * tp / (0.25 * n_gt + n_pred))
