"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Every text becomes a short vector of log-ratios (case, symbols, repetition, word shape, line shape). For each
class the mean and a shrunken covariance are estimated; the Cholesky factor of each covariance is kept, so that a
score costs two triangular solves. The log-density difference is mapped to a probability by a two-parameter
logistic fit on rows kept out of the covariance estimate.

Defined results: a null text counts as an empty one; an empty text has statistics like any other; repeated rows get
equal scores; rows without a usable label are not learned from; if the labelled rows hold a single class or none,
every text scores 1, 0 or 0.5 (no rows). Extra columns are neither read nor required.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, hash_below, sample_rate

FEATURES = ("upper", "symbol", "punct", "digit", "adjacent", "distinct", "words", "word_len", "lines", "stops")
KEEP_AT = 0.7
#: Labelled rows the fit looks at (expected number; chosen by a hash of the id).
FIT_ROWS = 20_000
SHRINK = 0.02

_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _PUNCT, _STOP, _SYMBOL = range(8)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point of the basic plane; the last entry stands for all others."""
    out = np.full(0x10000, _SYMBOL, np.uint8)
    for code in range(0x10000):
        kind = unicodedata.category(chr(code))
        if kind[0] == "L" or kind[0] == "M":
            out[code] = _UPPER if kind in ("Lu", "Lt") else _LOWER
        elif kind[0] == "N":
            out[code] = _DIGIT
        elif kind[0] == "Z" or code in (9, 11, 12, 13):
            out[code] = _SPACE
    out[10] = _LINE
    out[[ord(c) for c in ",;:'\"()-–—’“”«»"]] = _PUNCT
    out[[ord(c) for c in ".?…"]] = _STOP
    out[0xFFFF] = _LOWER
    return out


def text_statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of one whole text, in the order of FEATURES."""
    text = text or ""
    table, counts = _classes(), np.zeros(8)
    for at in range(0, len(text), 1 << 20):  # bounded memory for giant texts
        codes = np.frombuffer(text[at:at + (1 << 20)].encode("utf-32-le", "surrogatepass"), "<u4")
        counts += np.bincount(table[np.minimum(codes, 0xFFFF)], minlength=8)
    words = text.split()
    n, chars = len(words), len(text)
    letters = counts[_LOWER] + counts[_UPPER]
    ratio = lambda part, whole: np.log(part / max(whole, 1.0) + 0.02)  # noqa: E731  the floor keeps short texts in line
    return np.array([
        ratio(counts[_UPPER], letters), ratio(counts[_SYMBOL], chars), ratio(counts[_PUNCT], chars),
        ratio(counts[_DIGIT], chars), ratio(sum(map(eq, words, islice(words, 1, None))), n), ratio(len(set(words)), n),
        np.log1p(n), ratio(letters, n), ratio(counts[_LINE], n), ratio(counts[_STOP], n),
    ])


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log-determinants of both classes, and the logistic map of the score."""
    means: np.ndarray       # [2, d]
    whiten: np.ndarray      # [2, d, d]: inverse of the lower Cholesky factor
    log_dets: np.ndarray    # [2]
    slope: float
    offset: float

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log density of class 1 less that of class 0, for rows of statistics."""
        dens = [-0.5 * (((x - self.means[k]) @ self.whiten[k].T) ** 2).sum(axis=1) - 0.5 * self.log_dets[k] for k in (0, 1)]
        return dens[1] - dens[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * np.arcsinh(self.difference(x)) + self.offset
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def _constant(p: float, d: int = len(FEATURES)) -> Discriminant:
    offset = {0.0: -500.0, 1.0: 500.0}.get(p, 0.0)
    return Discriminant(np.zeros((2, d)), np.stack([np.eye(d)] * 2), np.zeros(2), 0.0, offset)


def fit_discriminant(x: np.ndarray, y: np.ndarray, calibrate: np.ndarray, shrink: float = SHRINK) -> Discriminant:
    """``calibrate`` marks the rows that only the logistic map sees."""
    if len(y) == 0 or y.min() == y.max():
        return _constant(float(y[0]) if len(y) else 0.5)
    means, whiten, dets = [], [], []
    pooled = x.var(axis=0) + 1e-6
    fit = ~calibrate if all((y[~calibrate] == k).sum() > 1 for k in (0, 1)) else np.ones(len(y), bool)
    for k in (0, 1):
        rows = x[fit & (y == k)]
        # few rows pull the estimate further towards the pooled diagonal
        weight = min(1.0, shrink + x.shape[1] / (x.shape[1] + len(rows)))
        cov = (np.cov(rows.T, bias=True) if len(rows) > 1 else np.zeros((x.shape[1],) * 2)) * (1 - weight) + weight * np.diag(pooled)
        chol = np.linalg.cholesky(cov)
        means.append(rows.mean(axis=0))
        whiten.append(np.linalg.inv(chol))
        dets.append(2 * np.log(np.diag(chol)).sum())
    model = Discriminant(np.array(means), np.array(whiten), np.array(dets), 1.0, 0.0)
    held = calibrate if all((y[calibrate] == k).sum() > 1 for k in (0, 1)) else np.ones(len(y), bool)
    z, t = np.arcsinh(model.difference(x[held])), y[held].astype(float)
    # targets pulled off 0 and 1, so that separable rows still give a finite fit
    t = np.where(t == 1, (t.sum() + 1) / (t.sum() + 2), 1 / ((1 - t).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -500, 500)))
        w = p * (1 - p) + 1e-9
        grad = np.array([((p - t) * z).sum() + 1e-3 * a, (p - t).sum()])
        step = np.linalg.solve(np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum()]]), grad)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return Discriminant(model.means, model.whiten, model.log_dets, float(max(a, 1e-6)), float(b))


def statistics_column(text: str) -> Column:
    @F.pandas_udf("array<double>")
    def stats(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([text_statistics(t) for t in part], dtype=object)
    return stats(F.col(text))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        fit_rows: int = FIT_ROWS) -> Discriminant:
    """Learn from at most about ``fit_rows`` labelled ids. Several labels of an id count as the largest one; of several
    rows of an id one is used. What reaches the driver is one short vector for each sampled id."""
    usable = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
              .where(F.col("id").isNotNull() & F.col("y").isin(0, 1)).groupBy("id").agg(F.max("y").alias("y")))
    rate = sample_rate(usable.count(), fit_rows)
    chosen = usable.where(hash_below("id", rate, 11))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(chosen), "id")
            .select("id", "y", statistics_column("t").alias("x"), hash_below("id", 0.25, 12).alias("c"))
            .groupBy("id").agg(F.min(F.struct("x", "y", "c")).alias("r")).select("id", "r.*").orderBy("id").toPandas())
    if not len(rows):
        return _constant(0.5)
    return fit_discriminant(np.array(rows["x"].tolist(), float), rows["y"].to_numpy(int), rows["c"].to_numpy(bool))


def score_column(model: Discriminant, text: str) -> Column:
    """Probability of label 1 for the text in column ``text``."""
    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            x = np.array([text_statistics(t) for t in part], float).reshape(-1, len(FEATURES))
            yield pd.Series(model.score(x))
    return score(F.col(text))


def keep_good(docs: DataFrame, model: Discriminant, text_col: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that score at least ``keep_at``, with their own columns."""
    name = fresh(docs, "quality_score")
    return docs.withColumn(name, score_column(model, text_col)).where(F.col(name) >= keep_at).drop(name)
