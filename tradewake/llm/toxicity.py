"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al., 2017) with sparse linear classifiers in numpy.

Known are confirmed toxic texts (P) and texts of unknown class (U). With the class prior p, the risk of calling U clean
is corrected by what the toxic share of U contributes: p * R_P(toxic) + max(0, R_U(clean) - p * R_P(clean)). Where the
second part turns negative, training steps back along it, so the classifier does not overfit to U.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewake.llm.frames import column, store

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5, 6)


def features(text: str | None) -> set[str]:
    """Distinct lower-cased words of the whole text, and their beginnings of three to six letters."""
    found = set(WORD.findall((text or "").lower()))
    return found | {w[:k] + "-" for w in found for k in PREFIXES if len(w) > k}


class Sparse:
    """Rows of feature numbers, as one flat array and row starts."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.width, self.n = width, len(rows)
        self.flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=weights[self.flat], minlength=self.n)

    def back(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.flat, weights=errors[self.row], minlength=self.width)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: Iterable[set[str]], unlabelled: Iterable[set[str]], prior: float, steps: int = 300, rate: float = 0.02,
        sparsity: float = 1e-3, least_texts: int = 3) -> dict[str, float]:
    """Weights of features (the bias under the empty string) that minimise the non-negative risk with logistic loss.

    Features of fewer than ``least_texts`` training texts are left out; a soft threshold of ``sparsity`` per step keeps
    the others at zero unless they matter. Without positive or without unlabelled texts every score is the prior.
    """
    start = float(np.log(prior / (1 - prior)))
    number: dict[str, int] = {}
    # one text's features at a time become numbers: a set of strings for every text would not fit
    sides = [[np.array([number.setdefault(f, len(number)) for f in sorted(row)], np.int32) for row in rows] for rows in (positive, unlabelled)]
    if not all(sides):
        return {"": start}
    seen = np.bincount(np.concatenate([r for side in sides for r in side]), minlength=len(number))
    names = sorted(f for f, k in number.items() if seen[k] >= least_texts)
    place = np.full(len(number), -1, np.int64)
    place[[number[f] for f in names]] = np.arange(len(names))
    p, u = (Sparse([x[x >= 0] for x in (place[r] for r in side)], len(names)) for side in sides)
    weights, bias = np.zeros(len(names)), start
    first, second, first_b, second_b = np.zeros(len(names)), np.zeros(len(names)), 0.0, 0.0
    for step in range(1, steps + 1):
        sp, su = _sigmoid(p.dot(weights) + bias), _sigmoid(u.dot(weights) + bias)
        # risks of calling texts clean: -log(1 - s); of calling P toxic: -log(s)
        rest = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
        ep, eu = -prior * sp / p.n, su / u.n
        if rest < 0:  # the clean part has been overfitted: step back along it
            ep, eu = -ep, -eu
        else:
            ep = ep + prior * (sp - 1) / p.n
        grad, grad_b = p.back(ep) + u.back(eu), ep.sum() + eu.sum()
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        first_b, second_b = 0.9 * first_b + 0.1 * grad_b, 0.999 * second_b + 0.001 * grad_b**2
        grown, grown_b = 1 - 0.9**step, 1 - 0.999**step
        scale = rate / (np.sqrt(second / grown_b) + 1e-4)
        weights -= scale * first / grown
        weights = np.sign(weights) * np.maximum(np.abs(weights) - scale * sparsity, 0)
        bias -= rate * first_b / grown / (np.sqrt(second_b / grown_b) + 1e-4)
    return {"": bias} | {names[k]: float(weights[k]) for k in np.flatnonzero(weights)}


def held_out(id_col: str) -> F.Column:
    """Rows whose labels are never learned from; a null id counts as learned from."""
    return F.coalesce(F.crc32(column(id_col).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", classifiers: int = 3,
          most_positive: int = 3000, most_unlabelled: int = 5000, prior: float | None = None) -> list[dict[str, float]]:
    """``classifiers`` classifiers, each fitted by one task on its own bounded sample.

    Labels come from rows that are not ``held_out``. P are texts labelled 1, U are texts of any label or none, both from
    rows not held out: at most ``most_positive`` and ``most_unlabelled`` texts a classifier, those of least hash of id
    and classifier. ``prior`` is the share of toxic texts; by default the share among all labels learned from. Several
    labels of one id count as toxic if one is 1; null ids and labels other than 0 and 1 are ignored.
    """
    spark = docs.sparkSession
    known = (
        labels.where(~held_out(id_col) & column(id_col).isNotNull() & column(label_col).isin(0, 1))
        .groupBy(column(id_col).cast("long").alias("id")).agg(F.max(column(label_col)).alias("label"))
    )
    known = store(known, "toxic-labels")
    if prior is None:
        prior = known.agg(F.avg("label")).first()[0]
    prior = min(max(float(prior or 0.0), 1e-3), 0.5)
    ids = docs.where(~held_out(id_col) & column(id_col).isNotNull()).select(column(id_col).cast("long").alias("id"))
    picks = None
    for k in range(classifiers):
        order = F.xxhash64(F.lit(k), "id")
        for label, rows, most in ((1, known.where("label = 1").select("id"), most_positive), (0, ids, most_unlabelled)):
            part = rows.orderBy(order, "id").limit(most).select("id", F.lit(k).alias("classifier"), F.lit(label).alias("positive"))
            picks = part if picks is None else picks.union(part)
    picks = store(picks.distinct(), "toxic-picks")
    # at most classifiers * (most_positive + most_unlabelled) short rows: safe to broadcast
    texts = docs.select(column(id_col).cast("long").alias("id"), column(text_col).alias("text")).join(F.broadcast(picks), "id")

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["positive", "id", "text"], kind="stable")
        p, u = (map(features, frame.loc[frame["positive"] == side, "text"]) for side in (1, 0))
        weights = fit(p, u, prior)
        return pd.DataFrame({"classifier": frame["classifier"].iloc[0], "feature": list(weights), "weight": list(weights.values())})

    rows = texts.groupBy("classifier").applyInPandas(one, "classifier int, feature string, weight double").toPandas()
    if rows.empty:
        return [{"": float(np.log(prior / (1 - prior)))}]
    return [dict(zip(part["feature"], part["weight"])) for _, part in rows.sort_values(["classifier", "feature"]).groupby("classifier")]


def score(docs: DataFrame, models: list[dict[str, float]], text_col: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, 0 to 1: the sigmoid of the mean of the classifiers' sums of weights.

    A null or empty text has the score of the biases. A column named ``to`` is replaced. The models hold the non-zero
    weights only, at most a few per feature of the bounded samples; they are broadcast.
    """
    spark: SparkSession = docs.sparkSession
    total: dict[str, float] = {}
    for model in models:
        for feature, weight in model.items():
            total[feature] = total.get(feature, 0.0) + weight / len(models)
    shared = spark.sparkContext.broadcast(total)

    def each(texts: pd.Series) -> pd.Series:
        weights = shared.value
        bias = weights[""]
        words = {f for f in weights if f and not f.endswith("-")}
        starts = {f[:-1] for f in weights if f.endswith("-")}

        def one(text: str | None) -> float:
            found = set(WORD.findall((text or "").lower()))
            hits = [weights[w] for w in found & words]
            hits += [weights[s + "-"] for s in {w[:k] for w in found for k in PREFIXES if len(w) > k} & starts]
            return bias + sum(sorted(hits))

        return pd.Series(_sigmoid(np.array([one(t) for t in texts], float)))

    return docs.withColumn(to, F.pandas_udf(each, T.DoubleType())(column(text_col)))
