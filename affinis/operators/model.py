"""Models of pairs: boosted trees with early stopping, cross-fitted logistic combiner, pluggable expensive scorer."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fuzzy import ratio_of
from ..functions.numeric import logit


def assembled(df: DataFrame, features: list[str]) -> DataFrame:
    filled = df.na.fill(-1.0, features)
    return VectorAssembler(inputCols=features, outputCol="x").transform(filled)


def fit_trees(df: DataFrame, features: list[str], label: str = "label", stop: str | None = None, rounds: int = 20, depth: int = 4, seed: int = 7, sample: float = 1.0) -> GBTClassificationModel:
    """stop: a boolean column that marks the rows whose loss ends training early."""
    data = assembled(df, features).withColumn(label, F.col(label).cast("double"))
    extra = {"validationIndicatorCol": stop} if stop else {}
    return GBTClassifier(featuresCol="x", labelCol=label, maxIter=rounds, maxDepth=depth, seed=seed, subsamplingRate=sample, **extra).fit(data)


def probability(model: GBTClassificationModel, df: DataFrame, features: list[str], out: str = "p") -> DataFrame:
    scored = model.transform(assembled(df, features))
    return scored.withColumn(out, vector_to_array("probability")[1]).drop("x", "rawPrediction", "probability", "prediction")


def importance(model: GBTClassificationModel, features: list[str]) -> list[tuple[str, float]]:
    return sorted(zip(features, model.featureImportances.toArray().tolist(), strict=True), key=lambda x: (-x[1], x[0]))


def cross_fitted(df: DataFrame, fold: str, folds: int, fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Each fold scored by what was fitted on the others."""
    out = None
    for k in range(folds):
        part = fit(df.where(F.col(fold) != k))(df.where(F.col(fold) == k))
        out = part if out is None else out.unionByName(part)
    return out


def bagged(df: DataFrame, features: list[str], seeds: tuple[int, ...], out: str = "p", **params) -> DataFrame:
    """df with the mean probability of models fitted with different seeds, each on a sample of the rows."""
    scored, names = df, []
    for seed in seeds:
        names.append(f"_p{seed}")
        scored = probability(fit_trees(df, features, seed=seed, sample=0.8, **params), scored, features, names[-1])
    return scored.withColumn(out, sum((F.col(n) for n in names), F.lit(0.0)) / len(names)).drop(*names)


def refitted(df: DataFrame, features: list[str], fold: str, folds: int, stop: str, rounds: int) -> GBTClassificationModel:
    """Fitted on all rows, with as many trees as early stopping keeps on average when a fold is left out."""
    kept = [fit_trees(df.where(F.col(fold) != k), features, stop=stop, rounds=rounds).getNumTrees for k in range(folds)]
    return fit_trees(df, features, rounds=max(1, round(sum(kept) / folds)))


def fit_combiner(df: DataFrame, p: str = "p", s: str = "s", label: str = "label") -> tuple[float, tuple[float, float, float]]:
    """(intercept, weights) of the logistic model on logit p, s and their product."""
    z = logit(F.col(p))
    data = assembled(df.select(z.alias("f1"), F.col(s).cast("double").alias("f2"), (z * F.col(s)).alias("f3"), F.col(label).cast("double").alias("label")), ["f1", "f2", "f3"])
    m = LogisticRegression(featuresCol="x", labelCol="label", regParam=1e-4).fit(data)
    return m.intercept, tuple(m.coefficients.toArray().tolist())


def lexical(pdf: pd.DataFrame) -> pd.Series:
    """The default scorer of text pairs (a, b): their ratio, 0 to 1."""
    return pd.Series([ratio_of(a, b) / 100 for a, b in zip(pdf["a"], pdf["b"], strict=True)], index=pdf.index, dtype="float64")


def in_band(df: DataFrame, lo: float, hi: float, scorer: Callable[[pd.DataFrame], pd.Series] = lexical, p: str = "p") -> DataFrame:
    """df (with texts a and b) with s: the scorer's value where lo <= p <= hi, 0 elsewhere; only the band reaches Python."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(s=scorer(pdf).astype("float64"))

    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", s double"
    inside = F.col(p).between(lo, hi)
    return df.where(inside).mapInPandas(run, schema).unionByName(df.where(~inside | inside.isNull()).withColumn("s", F.lit(0.0)))
