"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

One pass measures every whole text. Means and covariances per class are plain sums over all labelled
rows that are not held out, so fitting moves one row of sums per class. Each class covariance is
shrunk towards the pooled one and towards its diagonal, factored once (Cholesky), and the factors travel
with the scoring tasks. The score is the share of class 1 in the two log densities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.session import stage

FEATURES = [
    "log_words", "mean_word", "symbol", "punctuation", "bang", "pipe", "upper", "digit", "wide", "space",
    "distinct", "top_word", "repeat", "dup_line", "line_words", "symbol_ended",
]
WIDTH = len(FEATURES)
TOWARDS_POOLED = 0.2
TOWARDS_DIAGONAL = 0.2
FLOOR = 1e-3  # added to every variance of the standardised statistics
TEMPERATURE = 16.0  # log odds are divided by this: the statistics have heavier tails than a normal law
THRESHOLD = 0.7

_SYMBOLS = np.array([*b"#*$%&<>~^_=+@\\{}[]"])
_PUNCT = np.array([*b".,;:?\"'()-"])


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text; those of an empty text are all 0 but for none."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * WIDTH
    c = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    size = len(data)
    inked = max(1, size - int(c[9:14].sum() + c[32]))
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    repeated = sum(1 for a, b in zip(words, words[1:]) if a == b)
    lines = [x for x in data.split(b"\n") if x.strip()]
    ended = sum(1 for w in words if w[-1] in b"#*$%&!|<>")
    upper, lower = int(c[65:91].sum()), int(c[97:123].sum())
    root = lambda x: float(np.sqrt(x))
    return [
        float(np.log1p(n)),
        float(np.log(inked / n)),
        root(c[_SYMBOLS].sum() / inked),
        root(c[_PUNCT].sum() / inked),
        root(c[33] / inked),
        root(c[124] / inked),
        root(upper / max(1, upper + lower)),
        root(c[48:58].sum() / inked),
        root(c[128:].sum() / inked),
        root(1 - inked / size),
        float(np.log1p(len(counts)) / np.log1p(n)),
        root(max(counts.values()) / n) if n >= 8 else 0.0,
        root(repeated / n),
        root(1 - len(set(lines)) / len(lines)),
        float(np.log1p(n / len(lines))),
        root(ended / n),
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics(texts: pd.Series) -> pd.Series:
    return texts.map(statistics)


def with_statistics(docs: DataFrame) -> DataFrame:
    return docs.withColumn("stats", _statistics(F.col("text")))


@dataclass(frozen=True)
class Model:
    """Standardisation, prior and per class the mean, inverse Cholesky factor and log determinant.
    Without rows of both classes there is nothing to tell apart: every score is the prior."""

    centre: np.ndarray
    spread: np.ndarray
    prior: float
    classes: tuple[tuple[np.ndarray, np.ndarray, float], ...] = ()

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.classes:
            return np.full(len(x), self.prior)
        z = (x - self.centre) / self.spread
        logs = []
        for mean, whiten, logdet in self.classes:
            y = (z - mean) @ whiten.T
            logs.append(-0.5 * (y * y).sum(axis=1) - 0.5 * logdet)
        odds = (logs[1] - logs[0]) / TEMPERATURE + np.log(self.prior / (1 - self.prior))
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))


def fit(labelled: DataFrame) -> Model:
    """Fit on (label, stats). Rows with a null label or other labels than 0 and 1 don't count."""
    zero = np.zeros(WIDTH)
    rows = labelled.where("label in (0, 1)")
    x = [F.get("stats", i) for i in range(WIDTH)]
    top = rows.agg(*[F.avg(c) for c in x], *[F.stddev_pop(c) for c in x]).first()
    if top[0] is None:
        return Model(zero, zero + 1, 0.5)
    centre = np.array(top[:WIDTH], dtype=float)
    spread = np.array(top[WIDTH:], dtype=float)
    spread[spread < 1e-9] = 1.0
    # Sums of the upper triangle of z z', built as an array of products so that one class is one row.
    z = F.array(*[(c - F.lit(float(m))) / F.lit(float(s)) for c, m, s in zip(x, centre, spread)])
    pairs = [(i, j) for i in range(WIDTH) for j in range(i, WIDTH)]
    named = rows.select("label", z.alias("z"))
    sums = named.groupBy("label").agg(
        F.count("*").alias("n"), *[F.sum(F.get("z", i)).alias(f"s{i}") for i in range(WIDTH)], *[F.sum(F.get("z", i) * F.get("z", j)).alias(f"p{i}_{j}") for i, j in pairs]
    )
    found = {int(r["label"]): r for r in sums.collect()}
    total = sum(r["n"] for r in found.values())
    if len(found) < 2:
        return Model(centre, spread, float(next(iter(found))) if found else 0.5)
    means, covs = [], []
    for label in (0, 1):
        r = found[label]
        mean = np.array([r[f"s{i}"] for i in range(WIDTH)]) / r["n"]
        second = np.zeros((WIDTH, WIDTH))
        for i, j in pairs:
            second[i, j] = second[j, i] = r[f"p{i}_{j}"] / r["n"]
        means.append(mean)
        covs.append(second - np.outer(mean, mean))
    pooled = sum(found[k]["n"] * covs[k] for k in (0, 1)) / total
    classes = []
    for k in (0, 1):
        cov = (1 - TOWARDS_POOLED) * covs[k] + TOWARDS_POOLED * pooled
        cov = (1 - TOWARDS_DIAGONAL) * cov + TOWARDS_DIAGONAL * np.diag(np.diag(cov)) + FLOOR * np.eye(WIDTH)
        factor = np.linalg.cholesky(cov)
        classes.append((means[k], np.linalg.inv(factor), float(2 * np.log(np.diag(factor)).sum())))
    return Model(centre, spread, float(found[1]["n"] / total), tuple(classes))


def score(model: Model, stats: Column) -> Column:
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.scores(np.stack(batch.to_numpy())) if len(batch) else [], dtype="float64")

    return scored(stats)


def held_out(doc_id: Column) -> Column:
    """A quarter of the ids, by checksum; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_on_labels(measured: DataFrame, labels: DataFrame) -> Model:
    """Fit on ``measured`` (doc_id, stats) rows that ``labels`` (doc_id, quality) marks and that are not
    held out. Repeated labels of an id count once; an id with both labels counts for both."""
    known = labels.select("doc_id", F.col("quality").alias("label")).where("label is not null").distinct()
    return fit(measured.select("doc_id", "stats").join(known, "doc_id").where(~held_out(F.col("doc_id"))))


def classify(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all) of every row with ``held_out``, ``score`` and ``predicted``.

    Null and empty texts have all-zero statistics and are scored like any. Scores depend on the text alone.
    """
    keep = [c for c in (keep or docs.columns) if c not in ("held_out", "score", "predicted", "stats")]
    measured = stage(with_statistics(docs).select(*keep, "stats"), "quality-stats")
    model = fit_on_labels(measured, labels)
    scored = measured.withColumn("score", score(model, F.col("stats")))
    return scored.select(*keep, held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
