"""Language identification: sparse multinomial regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from outledger.llm import frames

BITS, LONGEST = 16, 3
BUCKETS = 1 << BITS
#: TF-IDF values of a text are small fractions; this brings them to the order of 1.
SCALE = 50.0

_LETTERS = np.arange(128, dtype=np.uint32)
_LETTERS[[c for c in range(128) if not chr(c).isalpha()]] = 32


def ngrams(text: str) -> np.ndarray:
    """Buckets of all runs of 1 to 3 characters; lower case, ASCII non-letters are blanks."""
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    code = np.where(code < 128, _LETTERS[np.minimum(code, 127)], code).astype(np.uint64)
    found, run = [], np.zeros(len(code) + 1, np.uint64)
    for n in range(1, LONGEST + 1):
        run = run[: len(code) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1 :] + np.uint64(n)
        mixed = (run ^ (run >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        found.append(mixed >> np.uint64(64 - BITS))
    return np.concatenate(found).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents with each bucket, and all documents. The driver gets one number per bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(BUCKETS + 1, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                there = np.zeros(BUCKETS, bool)
                there[ngrams(text)] = True
                total[:-1] += there
                n += 1
        total[-1] = n
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used, "n": total[used]})

    rows = texts.mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(BUCKETS + 1, np.int64)
    total[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return total[:-1], int(total[-1])


class Ftrl:
    """Follow-the-regularised-leader with L1 and L2 penalties, one weight row per bucket."""

    def __init__(self, classes: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((BUCKETS + 1, classes))
        self.n = np.zeros((BUCKETS + 1, classes))

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        step = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return -np.sign(z) * np.maximum(np.abs(z) - self.l1, 0) / step

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = softmax(x @ w)
        error[label] -= 1
        g = x[:, None] * error
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of all logits with the least log loss on rows not trained on (golden section)."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-300)).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    grams = ngrams(text)
    at, count = np.unique(grams, return_counts=True)
    # The last row is the bias.
    return np.append(at, BUCKETS), np.append(SCALE * count / len(grams) * idf[at], 1.0)


def fit(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = 1500, epochs: int = 3,
) -> tuple[list[str], np.ndarray]:
    """The languages, and per bucket the logit that one occurrence adds (last row: bias).

    Document frequencies cover all labelled rows. The weights are fitted on a bounded sample: about
    `per_language` rows of each language, chosen by a hash of the id, trained on by one task; every
    fifth of them is kept for the temperature. Rows without letters, or with a NULL text or language,
    teach nothing.
    """
    rows = (
        frames.pick(labelled, doc_id=id_col, text=text_col, lang=lang_col)
        .filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    )
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return [], np.zeros((BUCKETS + 1, 0), np.float32)
    frequency, n = document_frequencies(rows.select("text"))
    idf = np.log((1 + n) / (1 + frequency)) + 1
    share = F.create_map(*map(F.lit, chain(*((k, min(1.0, per_language / v)) for k, v in counts.items()))))
    ticket = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000))
    sample = rows.withColumn("ticket", ticket).filter(F.col("ticket") < share[F.col("lang")] * 1_000_000)

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        drawn = [b for b in batches if len(b)]
        every = pd.concat(drawn).sort_values(["ticket", "lang", "text"]) if drawn else pd.DataFrame({"text": [], "lang": []})
        number = {k: i for i, k in enumerate(languages)}
        data = [(_vector(t, idf), number[k]) for t, k in zip(every["text"], every["lang"], strict=True)]
        held, model = data[4::5], Ftrl(len(languages))
        taught = [d for k, d in enumerate(data) if k % 5 != 4]
        order = np.random.default_rng(3)
        for _ in range(epochs):
            for k in order.permutation(len(taught)):
                (at, x), label = taught[k]
                model.learn(at, x, label)
        weights = model.weights(slice(None))
        logits = np.array([x @ weights[at] for (at, x), _ in held]).reshape(-1, len(languages))
        weights /= temperature(logits, np.array([y for _, y in held], np.int64))
        weights[:-1] *= SCALE * idf[:, None]
        used = np.flatnonzero(weights.any(axis=1))
        yield pd.DataFrame({"bucket": used, "weights": list(weights[used])})

    # One task: the sample is bounded by a parameter.
    found = sample.select("ticket", "text", "lang").repartition(1).mapInPandas(
        train, "bucket long, weights array<double>"
    ).toPandas()
    table = np.zeros((BUCKETS + 1, len(languages)), np.float32)
    if len(found):
        table[found["bucket"].to_numpy(np.int64)] = np.stack(found["weights"].to_list())
    return languages, table


def identify(
    df: DataFrame, languages: list[str], table: np.ndarray, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, lang_pred and score (calibrated probability of lang_pred) of every row.

    `und` with score 0 where the text is NULL or has no letter, or where nothing was learned. Ties go
    to the first language by name. NULL ids and repeated rows are kept; other columns are not read.
    """
    rows = frames.pick(df, doc_id=id_col, text=text_col)
    sent = df.sparkSession.sparkContext.broadcast(table)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = sent.value
        for batch in batches:
            names, scores = [], []
            for text in batch["text"]:
                if not languages or not has_letter(text):
                    names.append("und")
                    scores.append(0.0)
                    continue
                grams = ngrams(text)
                total = np.zeros(len(languages))
                for k in range(0, len(grams), 1 << 16):
                    total += weights.take(grams[k : k + (1 << 16)], axis=0).sum(axis=0, dtype=np.float64)
                p = softmax(total / len(grams) + weights[-1])
                names.append(languages[int(p.argmax())])
                scores.append(float(p.max()))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": names, "score": scores})

    return rows.mapInPandas(run, f"doc_id {kind}, lang_pred string, score double")
