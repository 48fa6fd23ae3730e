"""Exact top-k inner products on a bit-sliced index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from outledger.llm import frames

#: Rows of an index block.
BLOCK_ROWS = 1 << 15
#: Quantised components must stay below this, so that 64 bits hold any inner product.
LARGEST = 2.0**24


def quantised(vectors: pd.Series, scale: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions of the usable vectors, and floor(scale * x) of each."""
    at, found = [], []
    for k, vector in enumerate(vectors):
        if vector is None:
            continue
        raw = np.asarray(vector)
        if raw.dtype == object:
            if any(x is None for x in raw):
                continue
            raw = raw.astype(np.float64)
        value = np.floor(scale * raw.astype(np.float64))
        if np.isfinite(value).all() and (np.abs(value) <= LARGEST).all():
            at.append(k)
            found.append(value.astype(np.int64))
    return np.array(at, np.int64), found


class SlicedIndex:
    """Vectors of one length as bitmaps: slice i of attribute d has bit i of (x_d - least) of each row.

    The `dropped` lowest bits stay out of the bitmaps; what they can add to a score is bounded.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, dropped: int = 2):
        self.ids, self.vectors = ids, vectors
        self.least = vectors.min(axis=0) if vectors.size else np.zeros(vectors.shape[1], np.int64)
        lifted = (vectors - self.least).astype(np.uint64)
        bits = int(lifted.max()).bit_length() if lifted.size else 0
        self.dropped = min(dropped, max(0, bits - 1))
        self.bits = max(1, bits - self.dropped)
        self.words = -(-len(ids) // 64)
        lifted >>= np.uint64(self.dropped)
        # (attribute, slice, word)
        self.slices = np.zeros((vectors.shape[1], self.bits, self.words), np.uint64)
        for i in range(self.bits):
            self.slices[:, i] = _bitmaps((lifted >> np.uint64(i) & np.uint64(1)).astype(bool).T, self.words)
        self.flipped = ~self.slices
        self.all = _bitmaps(np.ones((1, len(ids)), bool), self.words)[0]

    def sums(self, query: np.ndarray) -> np.ndarray:
        """Slices of sum(q_d * u_d) and a constant.

        Each |q_d| is written in digits -1, 0, 1 without two neighbours that count; an attribute is
        added at the digits of its sign and its complement at the others, so that sums only grow.
        """
        digits = _digits(query)
        total = np.zeros((self.bits + len(digits) + len(query).bit_length() + 1, self.words), np.uint64)
        for j, row in enumerate(digits):
            used = np.flatnonzero(row)
            if not len(used):
                continue
            width = self.bits + len(used).bit_length()
            partial, carry = np.zeros((2, width, self.words), np.uint64)
            tmp, both = np.empty((2, width, self.words), np.uint64)
            cut = np.empty((self.bits, self.words), np.uint64)
            for d in used:
                addend = (self.slices if row[d] > 0 else self.flipped)[d]
                # Carry-save: the carries of all slices move up together.
                np.bitwise_xor(partial, carry, out=tmp)
                np.bitwise_and(partial, carry, out=both)
                np.bitwise_and(tmp[: self.bits], addend, out=cut)
                both[: self.bits] |= cut
                tmp[: self.bits] ^= addend
                partial, tmp = tmp, partial
                carry[1:] = both[:-1]
            _add(total, partial, j)
            _add(total, carry, j)
        return total

    def top(self, query: np.ndarray, k: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of a superset of the k best rows, the rows at `own` left out."""
        total = self.sums(query)
        rows = self.all.copy()
        for p in own:
            rows[p >> 6] &= ~(np.uint64(1) << np.uint64(p & 63))
        sure, tied, bound = np.zeros_like(rows), rows.copy(), 0
        for i in reversed(range(len(total))):
            ones = tied & total[i]
            if _count(sure) + _count(ones) >= k:
                tied, bound = ones, bound | 1 << i
            else:
                sure |= ones
                tied = tied & ~total[i]
        # `bound` is the k-th best sum (0 with fewer rows). Dropped bits add less than `slack` to it.
        slack = int(np.abs(query).sum()) if self.dropped else 0
        near = _at_least(total, bound - slack, rows)
        at = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little")[: len(self.ids)])
        return at, self.vectors[at] @ query


def _digits(query: np.ndarray) -> np.ndarray:
    """Row j: the digit of weight 2**j of each number (non-adjacent form)."""
    rest, rows = query.copy(), []
    while rest.any():
        digit = np.where(rest & 1, 2 - (rest & 3), 0)
        rows.append(digit)
        rest = (rest - digit) >> 1
    return np.array(rows, np.int64).reshape(-1, len(query))


def _bitmaps(bits: np.ndarray, words: int) -> np.ndarray:
    packed = np.packbits(bits, axis=1, bitorder="little")
    padded = np.pad(packed, ((0, 0), (0, 8 * words - packed.shape[1])))
    return np.ascontiguousarray(padded).view(np.uint64)


def _add(total: np.ndarray, number: np.ndarray, shift: int) -> None:
    """total += number << shift, slice by slice."""
    carry = np.zeros(total.shape[1], np.uint64)
    for i in range(shift, len(total)):
        if i - shift < len(number):
            one = number[i - shift]
            half = total[i] ^ one
            carry, total[i] = total[i] & one | half & carry, half ^ carry
        else:
            if not carry.any():
                break
            carry, total[i] = total[i] & carry, total[i] ^ carry


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def _at_least(total: np.ndarray, bound: int, rows: np.ndarray) -> np.ndarray:
    """Rows whose sum is at least `bound`, from the most significant slice down."""
    if bound <= 0:
        return rows
    above, equal = np.zeros_like(rows), rows.copy()
    for i in reversed(range(len(total))):
        if bound >> i & 1:
            equal &= total[i]
        else:
            above |= equal & total[i]
            equal &= ~total[i]
    return above | equal


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to the smaller id."""
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def top_k(
    df: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 256.0,
    dropped: int = 2,
    queries_per_pass: int = 8192,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of `df` for each row of `queries`.

    The score is the inner product of floor(scale * x); rows with the query's id are not its
    candidates; ties go to the smaller id, and a query with fewer candidates has fewer rows. Each
    task builds index blocks of its own rows and keeps k rows per query; a pass sends a bounded
    block of queries to all tasks.

    NULL ids, NULL vectors, NULL, NaN or infinite components, and quantised components beyond 2**24
    take no part, as row or as query. Vectors of different lengths are not compared. Repeated rows
    are candidates each; a repeated query counts once. Empty tables give no rows.
    """
    rows = frames.pick(df, vec_id=id_col, embedding=vector_col).filter("vec_id is not null and embedding is not null")
    asked = frames.stored(
        frames.pick(queries, query_id=id_col, embedding=vector_col)
        .filter("query_id is not null and embedding is not null").distinct(),
        "queries",
    )
    passes = max(1, -(-asked.count() // queries_per_pass))
    turn = F.pmod(F.xxhash64("query_id"), F.lit(passes))
    found = None
    for p in range(passes):
        block = asked.filter(turn == p).toPandas()
        at, vectors = quantised(block["embedding"], scale)
        keys = block["query_id"].to_numpy()[at].astype(np.int64)
        sent = df.sparkSession.sparkContext.broadcast((keys, vectors))
        part = rows.mapInPandas(
            _search(sent, k, scale, dropped), "query_id long, variant int, vec_id long, score long"
        )
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id", "variant").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )


def _search(sent, k: int, scale: float, dropped: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, queries = sent.value
        best: list = [None] * len(keys)

        def look(ids: np.ndarray, vectors: np.ndarray) -> None:
            index = SlicedIndex(ids, vectors, dropped)
            order = np.argsort(ids, kind="stable")
            for n, (key, query) in enumerate(zip(keys, queries, strict=True)):
                if len(query) != vectors.shape[1]:
                    continue
                lo, hi = np.searchsorted(ids, [key, key + 1], sorter=order)
                at, scores = index.top(query, k, order[lo:hi])
                if best[n] is not None:
                    at_ids, scores = np.concatenate([best[n][0], ids[at]]), np.concatenate([best[n][1], scores])
                else:
                    at_ids = ids[at]
                best[n] = _best(at_ids, scores, k)

        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            at, vectors = quantised(batch["embedding"], scale)
            for key, vector in zip(batch["vec_id"].to_numpy()[at].astype(np.int64), vectors, strict=True):
                ids, same = held.setdefault(len(vector), ([], []))
                ids.append(key)
                same.append(vector)
                if len(ids) >= BLOCK_ROWS:
                    look(np.array(ids), np.stack(same))
                    del held[len(vector)]
        for ids, same in held.values():
            look(np.array(ids), np.stack(same))
        # Variants are the different vectors of a repeated query id.
        variant = pd.Series(keys).groupby(keys).cumcount().to_numpy() if len(keys) else []
        for n, pair in enumerate(best):
            if pair is not None:
                yield pd.DataFrame({"query_id": keys[n], "variant": variant[n], "vec_id": pair[0], "score": pair[1]})

    return run
