"""Quality classifier learned from trusted positives and unlabelled text (non-negative PU risk)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagemill.llm.batches import bound_batches

#: Expected numbers of fitted rows; more are thinned by a hash of doc_id and text, and repeated rows count once.
POSITIVES, UNLABELLED = 10_000, 20_000
HIDDEN, EPOCHS, RATE, SEED = 16, 400, 0.02, 7

_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)
_MARKS = b"!*#%$&@.,;:?-_/\\()[]{}<>=+|~^\"'`"
FEATURES = 10 + len(_MARKS)


def text_features(text: str) -> np.ndarray:
    """Shares of kinds of characters, repetition of words and lines, and lengths of a whole text."""
    raw = text.encode("utf-8", "replace")
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(1, len(raw))
    words, lines = text.split(), text.split("\n")
    return np.array([
        seen[_UPPER].sum() / n, seen[_LOWER].sum() / n, seen[128:].sum() / n, seen[_DIGIT].sum() / n, seen[32] / n, seen[10] / n,
        np.log1p(n), len(raw) / (1 + len(words)) / 10, len(set(words)) / (1 + len(words)), len(set(lines)) / len(lines),
        *(seen[list(_MARKS)] / n)])


def feature_table(texts: list[str | None]) -> np.ndarray:
    return np.array([text_features(t or "") for t in texts]).reshape(-1, FEATURES)


@dataclass
class Model:
    """A small network on square-rooted, standardised features; ``score`` is the probability of good text."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((np.sqrt(x) - self.mean) / self.scale, -8, 8)

    def logit(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b, c, d = self.weights
        hidden = np.tanh(z @ a + b)
        return hidden @ c + d, hidden

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(self.inputs(x))[0], -30, 30)))


def fit_nnpu(positives: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = HIDDEN, epochs: int = EPOCHS,
             rate: float = RATE, seed: int = SEED) -> Model:
    """Minimises  prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1))  with the logistic loss.

    Where the second term is negative, the step goes against it instead, so that the
    network cannot gain by fitting the unlabelled rows away (Kiryo et al.).  Full-batch
    Adam from a fixed seed: the same rows give the same model.
    """
    rows = np.sqrt(np.vstack([positives, unlabelled]))
    rng = np.random.default_rng(seed)
    model = Model(rows.mean(0), rows.std(0) + 1e-3, [
        rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, hidden)), np.zeros(hidden),
        rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)], prior)
    p, u = model.inputs(positives), model.inputs(unlabelled)
    z = np.vstack([p, u])
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in model.weights]
    for epoch in range(1, epochs + 1):
        f, h = model.logit(z)
        s = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
        fp, fu = f[: len(p)], f[len(p):]
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        sign = 1.0 if negative >= 0 else -1.0
        g = np.empty_like(f)  # slope of the risk in each logit
        g[: len(p)] = (prior * (s[: len(p)] - 1) * (negative >= 0) - sign * prior * s[: len(p)]) / len(p)
        g[len(p):] = sign * s[len(p):] / len(u)
        back = np.outer(g, model.weights[2]) * (1 - h * h)
        for w, m, slope in zip(model.weights, moments, (z.T @ back, back.sum(0), h.T @ g, np.array([g.sum()]))):
            slope = slope + 1e-4 * w
            m[0] = 0.9 * m[0] + 0.1 * slope
            m[1] = 0.999 * m[1] + 0.001 * slope**2
            w -= rate * (m[0] / (1 - 0.9**epoch)) / (np.sqrt(m[1] / (1 - 0.999**epoch)) + 1e-8)
    return model


def held_out(doc_id: Column) -> Column:
    """crc32 of doc_id as text leaves remainder 1 by 3; such rows never reach the fit."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _thinned(df: DataFrame, keys: DataFrame, wanted: int, salt: int) -> DataFrame:
    """About ``wanted`` of the (doc_id, text_hash) in ``keys`` by a hash of both, or all: the rows of ``df`` that have them."""
    total = keys.count()
    if total <= wanted:
        return df
    return df.where(F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(salt)), F.lit(1 << 30)) < int(wanted / total * (1 << 30)))


def fit(docs: DataFrame, labels: DataFrame, prior: float | None = None, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Fits on documents labelled good (quality 1, not held out) against unlabelled documents.

    The sample is bounded: about ``positives`` and ``unlabelled`` different rows of doc_id
    and text, however often a doc_id or a row is repeated.  Unlabelled rows
    are any documents not held out, their labels unseen.  The class prior is estimated
    as the share of good ones among the labelled rows not held out, within 0.05 to 0.95;
    with no such row it is 0.5.  A doc_id with conflicting labels is left out.  Without
    positives or documents the model is constant: every text scores the prior.
    """
    bound_batches(docs.sparkSession)
    known = (labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1)).groupBy("doc_id")
             .agg(F.min("quality").alias("low"), F.max("quality").alias("high")).where("low = high"))
    n, good = known.agg(F.count("*"), F.sum("high")).first()
    if prior is None:
        prior = min(0.95, max(0.05, good / n)) if n else 0.5
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).where(~held_out(F.col("doc_id")))
    keys = texts.select("doc_id", "text_hash").distinct()
    labelled = keys.join(known.where("high = 1").select("doc_id"), "doc_id")
    chosen = _thinned(labelled, labelled, positives, 1)
    # the positives' keys are bounded by the sample size
    rows = texts.join(F.broadcast(chosen), ["doc_id", "text_hash"]).select(F.lit(1).alias("kind"), "doc_id", "text_hash", "text").union(
        _thinned(texts, keys, unlabelled, 2).select(F.lit(0).alias("kind"), "doc_id", "text_hash", "text"))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"kind": batch["kind"], "doc_id": batch["doc_id"].astype("Int64"), "text_hash": batch["text_hash"],
                                "x": [x.tobytes() for x in feature_table(batch["text"].tolist())]})

    # bounded by the sample size: some 300 bytes a row
    once = rows.mapInPandas(features, "kind int, doc_id long, text_hash long, x binary").distinct()
    sample = once.select("kind", "x").toPandas()
    x, kind = np.frombuffer(b"".join(sample["x"])).reshape(-1, FEATURES), sample["kind"].to_numpy()
    # rows arrive in any order; a fixed one makes the sums, and so the model, the same each time
    order = np.lexsort([*x.T, kind])
    x, kind = x[order], kind[order]
    if not (kind == 1).any() or not (kind == 0).any():
        flat = [np.zeros((FEATURES, 1)), np.zeros(1), np.zeros(1), np.array([np.log(prior / (1 - prior))])]
        return Model(np.zeros(FEATURES), np.ones(FEATURES), flat, prior)
    return fit_nnpu(x[kind == 1], x[kind == 0], prior)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "quality_score") -> DataFrame:
    """Adds the score of every whole text, 0 to 1; a NULL text scores as an empty one.  All rows and columns stay."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.score(feature_table(texts.tolist())), dtype="float64")

    return docs.withColumn(out, scored(F.col(text)))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from a score of 0.5) of every document; one row per input row.

    Repeated rows score alike; a NULL doc_id is not held out; an empty table gives an
    empty table; other columns than doc_id and text are not looked at.
    """
    scored = score(docs.select("doc_id", "text"), fit(docs, labels), "text", "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
