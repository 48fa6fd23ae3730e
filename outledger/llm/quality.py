"""Quality of texts: a regularised quadratic discriminant over transformed document statistics.

Each class has a mean and a covariance of the statistics. Covariances are shrunk twice: towards the
pooled one, then towards their own diagonal; how far is chosen by cross-validation. A text's score is
the calibrated difference of the two log densities, each from the Mahalanobis distance by the cached
inverse Cholesky factor of the class.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from outledger.llm import frames

#: Kinds of UTF-8 bytes.
UPPER, LOWER, DIGIT, SPACE, LINE, SHOUT, MARK, OTHER = range(8)
KIND = np.full(256, OTHER, np.uint8)
KIND[:128] = MARK
KIND[ord("A") : ord("Z") + 1] = UPPER
KIND[ord("a") : ord("z") + 1] = LOWER
KIND[ord("0") : ord("9") + 1] = DIGIT
KIND[[0x09, 0x0B, 0x0C, 0x0D, 0x20]] = SPACE
KIND[0x0A] = LINE
KIND[[ord("!"), ord("?")]] = SHOUT

STATISTICS = (
    "bytes", "words", "word_bytes", "line_words", "upper", "digits", "shouts", "marks", "beyond_ascii",
    "distinct_words", "repeated_words", "commonest_word", "distinct_lines", "long_words", "letter_entropy",
)
#: Statistics are kept in steps of 1/STEP, so that sums are whole numbers and don't depend on their order.
STEP = 1 << 14


def _share(part: float, whole: float) -> float:
    """A share on the arcsine scale, where its spread depends less on its size."""
    return float(np.arcsin(np.sqrt(min(1.0, part / whole)))) if whole else 0.0


def statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of a whole text; NULL is an empty text."""
    raw = (text or "").encode("utf-8", "replace")
    codes = np.frombuffer(raw, np.uint8)
    kinds = np.bincount(KIND[codes], minlength=8)
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line]
    counts = Counter(words)
    n, held = len(words), sum(map(len, words))
    repeated = sum(a == b for a, b in zip(words, words[1:], strict=False))
    letters = np.bincount(codes[KIND[codes] <= LOWER] | 0x20, minlength=128)[97:123]
    p = letters[letters > 0] / max(1, letters.sum())
    found = [
        np.log1p(len(raw)),
        np.log1p(n),
        np.log1p(held / max(1, n)),
        np.log1p(n / max(1, len(lines))),
        _share(kinds[UPPER], kinds[UPPER] + kinds[LOWER]),
        _share(kinds[DIGIT], held),
        _share(kinds[SHOUT], held),
        _share(kinds[MARK], held),
        _share(kinds[OTHER], held),
        # Vocabulary grows more slowly than text: on the log scale, per log word.
        np.log1p(len(counts)) / max(1.0, np.log1p(n)),
        _share(repeated, max(1, n - 1)),
        _share(max(counts.values(), default=0), n),
        _share(len(set(lines)), len(lines)),
        _share(sum(len(w) > 20 for w in words), n),
        float(-(p * np.log(p)).sum()),
    ]
    return np.rint(np.array(found) * STEP) / STEP


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and constants of the two classes, and the calibration."""

    centre: np.ndarray
    spread: np.ndarray
    means: np.ndarray
    whiten: np.ndarray
    constant: np.ndarray
    slope: float = 1.0
    bias: float = 0.0

    def differences(self, x: np.ndarray) -> np.ndarray:
        """Log density (with prior) of class 1 less that of class 0, row by row."""
        z = (x - self.centre) / self.spread
        one, zero = (
            self.constant[k] - 0.5 * np.square((z - self.means[k]) @ self.whiten[k].T).sum(axis=1) for k in (1, 0)
        )
        return one - zero

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.differences(x) + self.bias, -500, 500)))


def discriminant(n: np.ndarray, sums: np.ndarray, outer: np.ndarray, alpha: float, gamma: float) -> Discriminant | None:
    """From the counts, sums and sums of outer products of both classes; None where a class is empty.

    `alpha` moves each covariance to the pooled one, `gamma` the result to its diagonal.
    """
    if (n == 0).any():
        return None
    whole = n.sum()
    centre = sums.sum(axis=0) / whole
    variance = np.diagonal(outer.sum(axis=0)) / whole - centre**2
    spread = np.sqrt(np.maximum(variance, 1e-6))
    means = sums / n[:, None]
    covariance = (outer / n[:, None, None] - means[:, :, None] * means[:, None, :]) / np.outer(spread, spread)
    pooled = (covariance * n[:, None, None]).sum(axis=0) / whole
    whiten, constant = [], []
    for k in (0, 1):
        shrunk = (1 - alpha) * covariance[k] + alpha * pooled
        shrunk = (1 - gamma) * shrunk + gamma * np.diag(np.diagonal(shrunk)) + 1e-4 * np.eye(len(centre))
        factor = np.linalg.cholesky(shrunk)
        whiten.append(np.linalg.inv(factor))
        constant.append(np.log(n[k] / whole) - np.log(np.diagonal(factor)).sum())
    return Discriminant(centre, spread, (means - centre) / spread, np.array(whiten), np.array(constant))


def log_loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.logaddexp(0, np.where(y == 1, -logits, logits)).sum())


def calibrated(logits: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Slope (not negative) and bias of the logistic curve through the differences, by Newton steps."""
    w = np.array([1.0, 0.0])
    design = np.column_stack([np.clip(logits, -60, 60), np.ones(len(logits))])
    for _ in range(60):
        p = 1 / (1 + np.exp(-design @ w))
        gradient = design.T @ (y - p) - ridge * (w - [1.0, 0.0])
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + ridge * np.eye(2)
        w = w + np.clip(np.linalg.solve(hessian, gradient), -0.5, 0.5)
        w[0] = max(w[0], 1e-3)
    return float(w[0]), float(w[1])


def _moments(rows: DataFrame, folds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, sums and sums of outer products by fold and class."""
    d = len(STATISTICS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2 * folds, 1 + d + d * d), np.int64)
        for batch in batches:
            if len(batch):
                x = np.rint(np.stack(batch["x"].to_list()) * STEP).astype(np.int64)
                each = np.concatenate([np.ones((len(x), 1), np.int64), x, (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)], axis=1)
                np.add.at(total, (2 * batch["fold"] + batch["label"]).to_numpy(np.int64), each)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"cell": at, "held": total.reshape(-1)[at]})

    cells = rows.mapInPandas(run, "cell long, held long").groupBy("cell").agg(F.sum("held").alias("held")).toPandas()
    total = np.zeros(2 * folds * (1 + d + d * d))
    total[cells["cell"].to_numpy(np.int64)] = cells["held"].to_numpy(np.int64)
    total = total.reshape(folds, 2, -1)
    return total[..., 0], total[..., 1 : 1 + d] / STEP, total[..., 1 + d :].reshape(folds, 2, d, d) / STEP**2


def fit(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    most_labelled: int = 30_000, folds: int = 5,
    alphas: tuple[float, ...] = (0.0, 0.1, 0.3, 0.6), gammas: tuple[float, ...] = (0.0, 0.05, 0.2, 0.5),
) -> Discriminant | None:
    """The discriminant of labelled rows (0 or 1); None where one of the classes has none.

    Labelled rows are a bounded sample of about `most_labelled`, by a hash of the id. Rows with a NULL
    id, text or label, or another label, teach nothing; an id with several labels teaches each. The
    two shrinkages are those with the least log loss over folds that were left out (folds by a hash
    of the text, so that copies share one); these folds' differences also set the calibration.
    """
    teach = frames.pick(labels, doc_id=id_col, label=label_col).filter("doc_id is not null and label in (0, 1)")
    n = teach.count()
    if n > most_labelled:
        ticket = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000))
        teach = teach.filter(ticket < F.lit(1_000_000.0 * most_labelled / n))
    docs = frames.pick(df, doc_id=id_col, text=text_col).filter("text is not null")

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "fold": batch["fold"], "label": batch["label"], "x": [statistics(t) for t in batch["text"]],
            })

    # Bounded by `most_labelled`.
    chosen = docs.join(F.broadcast(teach), "doc_id").select(
        F.pmod(F.xxhash64("text"), F.lit(folds)).cast("int").alias("fold"), F.col("label").cast("int"), "text"
    )
    rows = frames.stored(chosen.mapInPandas(described, "fold int, label int, x array<double>"), "quality-sample")
    counts, sums, outer = _moments(rows, folds)
    whole = [part.sum(axis=0) for part in (counts, sums, outer)]
    grid = list(product(alphas, gammas))
    models = [
        [discriminant(*(w - part[f] for w, part in zip(whole, (counts, sums, outer), strict=True)), a, g) for a, g in grid]
        for f in range(folds)
    ]
    if discriminant(*whole, *grid[-1]) is None:
        return None

    def left_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for fold, part in batch.groupby("fold"):
                if models[fold][0] is not None:
                    x = np.stack(part["x"].to_list())
                    found = np.stack([m.differences(x) for m in models[fold]], axis=1)
                    yield pd.DataFrame({"label": part["label"], "differences": list(found)})

    # One number per sampled row and setting: bounded too. Sorted, so that sums don't depend on the order of rows.
    seen = rows.mapInPandas(left_out, "label int, differences array<double>").toPandas()
    if not len(seen):
        return discriminant(*whole, *grid[-1])
    y, found = seen["label"].to_numpy(), np.stack(seen["differences"].to_list())
    order = np.lexsort((y, found[:, 0]))
    y, found = y[order], found[order]
    curves = [calibrated(found[:, k], y) for k in range(len(grid))]
    losses = [round(log_loss(s * found[:, k] + b, y), 6) for k, (s, b) in enumerate(curves)]
    best = int(np.argmin(losses))
    model = discriminant(*whole, *grid[best])
    return Discriminant(**(vars(model) | {"slope": curves[best][0], "bias": curves[best][1]}))


def score(
    df: DataFrame, model: Discriminant | None, id_col: str = "doc_id", text_col: str = "text", at_least: float = 0.7
) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (score >= `at_least`) of every row.

    NULL and empty texts get the score of a text without any byte. Without a model every score is 0.5.
    NULL ids and repeated rows are kept; other columns are not read; an empty table gives no rows.
    """
    rows = frames.pick(df, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if model is None or not len(batch):
                scores = np.full(len(batch), 0.5)
            else:
                scores = model.scores(np.stack([statistics(t) for t in batch["text"]]))
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "score": scores, "predicted": (scores >= at_least).astype(np.int32),
            })

    return rows.mapInPandas(run, f"doc_id {kind}, score double, predicted int")
