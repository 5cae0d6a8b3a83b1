"""§2.9 SQL-ML and text operators.

Training is distributed: a linear model is solved from counts of pairs of
levels, which one aggregate pass gives, the text classifier is a ``pyspark.ml``
pipeline.  Only the fitted model returns to the driver.  Feature transforms
live inside the model so scoring takes raw columns, like a model created with
a TRANSFORM clause.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Levels of all categorical columns together; the normal equations are a square of this side on the driver.
MAX_LEVELS = 5_000


def pair_counts(df: DataFrame, label: str, categorical: Sequence[str]) -> DataFrame:
    """The sufficient statistics of a regression on categorical columns: per pair of levels
    (c1 = v1, c2 = v2) the count of rows, and for a level with itself the sum of the label.

    Statistics of parts of a table add up to those of the whole.  Rows are first
    collapsed to one per combination of levels by a partial aggregate.  A NULL is a level;
    rows without a label are left out."""
    y = F.col(f"`{label}`").cast("double")
    cells = df.filter(y.isNotNull()).groupBy(*[F.col(f"`{c}`").cast("string").alias(f"c{k}") for k, c in enumerate(categorical)]).agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).alias("s"))
    each = [F.struct(F.lit(i).alias("c1"), F.col(f"c{i}").alias("v1"), F.lit(j).alias("c2"), F.col(f"c{j}").alias("v2"))
            for i in range(len(categorical)) for j in range(i, len(categorical))]
    pairs = cells.select(F.explode(F.array(*each)).alias("p"), "n", "s").select("p.*", "n", "s")
    return pairs.groupBy("c1", "v1", "c2", "v2").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


@dataclass
class LinearModel:
    """Intercept plus one coefficient per level of each categorical column (0 for the first one);
    ``transform`` is a SELECT over ``__THIS__`` that scoring runs first."""
    label: str
    categorical: tuple[str, ...]
    intercept: float
    coefficients: list[tuple[int, str | None, float]]
    n_coefficients: int
    transform: str | None = None

    def prepared(self, df: DataFrame) -> DataFrame:
        return df.sparkSession.sql(self.transform.replace("__THIS__", "{df}"), df=df) if self.transform else df

    def predict(self, df: DataFrame, out: str | None = None) -> DataFrame:
        """The (transformed) rows with their prediction; a level that was not trained on adds 0."""
        df, total = self.prepared(df), F.lit(self.intercept)
        table = df.sparkSession.createDataFrame(self.coefficients or [(-1, None, 0.0)], "c int, v string, b double")
        for k, c in enumerate(self.categorical):
            # bounded by MAX_LEVELS
            of = F.broadcast(table.filter(F.col("c") == k).select(F.col("v").alias(f"__v{k}"), F.col("b").alias(f"__b{k}")))
            df = df.join(of, F.col(f"`{c}`").cast("string").eqNullSafe(F.col(f"__v{k}")), "left")
            total = total + F.coalesce(f"__b{k}", F.lit(0.0))
        df = df.withColumn(out or f"predicted_{self.label}", total)
        return df.drop(*[f"__{x}{k}" for x in "vb" for k in range(len(self.categorical))])


def linreg(df: DataFrame, label: str, categorical: Sequence[str], transform: str | None = None) -> LinearModel:
    """ml.linreg_*: least squares on categorical columns, each dummy-coded, with an intercept.

    One pass over the rows; the normal equations are solved once from the counts of
    pairs of levels.  Where they are singular (a level that only occurs with another one),
    the solution of least length is taken, which predicts the same."""
    model = LinearModel(label, tuple(categorical), 0.0, [], 0, transform)
    got = pair_counts(model.prepared(df), label, categorical).limit(MAX_LEVELS * MAX_LEVELS + 1).collect()
    levels = sorted({(r.c1, r.v1) for r in got} | {(r.c2, r.v2) for r in got}, key=lambda x: (x[0], x[1] is not None, x[1] or ""))
    if len(levels) > MAX_LEVELS:
        raise ValueError(f"more than {MAX_LEVELS} levels")
    base = {min((x for x in levels if x[0] == k), key=levels.index) for k in {c for c, _ in levels}}
    place = {x: k + 1 for k, x in enumerate(x for x in levels if x not in base)}
    g, t = np.zeros((len(place) + 1,) * 2), np.zeros(len(place) + 1)
    for r in got:
        i, j = place.get((r.c1, r.v1)), place.get((r.c2, r.v2))
        if (r.c1, r.v1) == (r.c2, r.v2):
            if r.c1 == 0:
                g[0, 0] += r.n
                t[0] += r.s
            if i:
                g[0, i] = g[i, 0] = r.n
                t[i] = r.s
        if i and j:
            g[i, j] = g[j, i] = r.n
    beta = np.linalg.lstsq(g, t, rcond=None)[0]
    model.intercept, model.n_coefficients = float(beta[0]), len(place)
    model.coefficients = [(c, v, float(beta[k])) for (c, v), k in place.items()]
    return model


def evaluate_regression(model: LinearModel, train: DataFrame, test: DataFrame, name: str) -> DataFrame:
    """ML.EVALUATE: one row of metrics of a fitted model over rows it was not fitted on."""
    y = F.col(f"`{model.label}`").cast("double")
    r = y - F.col(f"predicted_{model.label}")
    n = F.count(r)
    got = model.predict(test).agg(F.sqrt(F.avg(r * r)).alias("rmse"), F.avg(F.abs(r)).alias("mae"),
                                  (1 - F.try_divide(F.sum(r * r), F.var_pop(y) * n)).alias("r2"), n.alias("n_test"))
    seen = model.prepared(train).agg(F.count(y).alias("n_train"))
    return got.crossJoin(F.broadcast(seen)).select(F.lit(name).alias("model"), "rmse", "mae", "r2",
                                                   F.lit(model.n_coefficients).alias("n_coefficients"), "n_train", "n_test")


def text_classifier(train: DataFrame, text: str, label: str, num_features: int = 1 << 18) -> PipelineModel:
    """ml.text_classify: tokenise whole texts, hashed term frequencies, IDF,
    logistic regression."""
    stages = [RegexTokenizer(inputCol=text, outputCol="__tokens", pattern=r"\W+", minTokenLength=1),
              HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=num_features),
              IDF(inputCol="__tf", outputCol="__tfidf"),
              LogisticRegression(featuresCol="__tfidf", labelCol=label, maxIter=50, regParam=0.01)]
    return Pipeline(stages=stages).fit(train)


def classify(model: PipelineModel, df: DataFrame, text: str, labels: Sequence[str]) -> DataFrame:
    """Score documents: (top category, its confidence); documents with no
    tokens get no category and are dropped."""
    out = model.transform(df)
    probs = vector_to_array("probability")
    best = F.array_position(probs, F.array_max(probs)) - 1
    names = F.array(*[F.lit(x) for x in labels])
    return (out.filter(F.size("__tokens") > 0)
               .select(*df.columns, F.element_at(names, (best + 1).cast("int")).alias("category"),
                       F.array_max(probs).alias("confidence")))


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """ml.confusion: TP / FP / TN / FN and the rates built from them, one pass."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    c = df.agg(F.count(F.when(y & p, 1)).alias("tp"), F.count(F.when(~y & p, 1)).alias("fp"),
               F.count(F.when(~y & ~p, 1)).alias("tn"), F.count(F.when(y & ~p, 1)).alias("fn"))
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    return c.select("tp", "fp", "tn", "fn",
                    F.try_divide(fp, fp + tn).alias("fpr"), F.try_divide(fn, tp + fn).alias("fnr"),
                    F.try_divide(tp, tp + fn).alias("tpr"), F.try_divide(tp + tn, tp + tn + fp + fn).alias("accuracy"),
                    F.try_divide(tp, tp + fp).alias("precision"))
