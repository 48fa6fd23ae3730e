"""Hard negatives: per anchor and positive the best rows of other labels in a window below the positive.

The scores of an anchor's positives are the upper limits of its windows. They cut the scores into
disjoint slots, so a row is counted in one slot however many windows hold it. Every task keeps the
best rows of each slot; a window's best rows are the first of its own slot and all lower ones, so
one list by descending score answers all windows of an anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from outledger.llm import frames

#: Vectors of a block of candidates, and of a block of anchors: their scores fit a task's memory.
ROWS, ANCHORS = 1 << 13, 1 << 9
#: Partitions that pairs of blocks are dealt to, at most.
TASKS = 4096
#: Packed vectors of one length: ids, label numbers, row numbers, limits and components.
BLOCK = "width int, ids binary, labels binary, numbers binary, limits binary, vectors binary"


def quantised(vectors: pd.Series, scale: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions of the usable vectors, and floor(scale * x) of each as doubles."""
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
        if np.isfinite(value).all():
            at.append(k)
            found.append(value)
    return np.array(at, np.int64), found


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of whole numbers, exact; an error where one leaves 64 bits."""
    bound = np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * a.shape[1]
    if bound < 2.0**53:
        return (a @ b.T).astype(np.int64)
    if bound < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = [np.array([int(x) for x in m.reshape(-1)], object).reshape(m.shape) for m in (a, b)]
    exact = whole[0] @ whole[1].T
    if any(not -(1 << 63) <= x < 1 << 63 for x in exact.reshape(-1)):
        raise OverflowError("an inner product needs more than 64 bits")
    return exact.astype(np.int64)


def blocks(rows: DataFrame, scale: float, most: int) -> DataFrame:
    """Rows (id, label, number, limits, vector) packed: up to `most` usable vectors of one length a row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}

        def packed(width: int) -> pd.DataFrame:
            ids, labels, numbers, limits, vectors = zip(*held.pop(width), strict=True)
            values = np.stack(vectors)
            # Whole numbers up to 2**24 need four bytes.
            small = np.abs(values).max(initial=0.0) <= 2.0**24
            found = {"width": width, "vectors": values.astype("<f4" if small else "<f8").tobytes()}
            found |= {n: np.array(v, "<i8").tobytes() for n, v in (("ids", ids), ("labels", labels), ("numbers", numbers), ("limits", limits))}
            return pd.DataFrame([found])[["width", "ids", "labels", "numbers", "limits", "vectors"]]

        for batch in batches:
            at, vectors = quantised(batch["vector"], scale)
            for row in zip(*(batch[c].to_numpy()[at] for c in ("id", "label", "number", "limits")), vectors, strict=True):
                same = held.setdefault(len(row[-1]), [])
                same.append(row)
                if len(same) == most:
                    yield packed(len(row[-1]))
        for width in list(held):
            yield packed(width)

    return rows.select("id", "label", "number", "limits", "vector").mapInPandas(run, BLOCK)


class Block:
    """A packed row as arrays, by ascending id."""

    def __init__(self, width: int, ids: bytes, labels: bytes, numbers: bytes, limits: bytes, vectors: bytes):
        ids = np.frombuffer(ids, "<i8")
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.numbers = ids[order], np.frombuffer(labels, "<i8")[order], np.frombuffer(numbers, "<i8")[order]
        self.limits = np.frombuffer(limits, "<i8").reshape(len(ids), -1)[order]
        kind = "<f4" if len(vectors) == 4 * width * len(ids) else "<f8"
        self.vectors = np.frombuffer(vectors, kind).reshape(len(ids), width)[order].astype(np.float64)


def best(group: np.ndarray, score: np.ndarray, id_: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores of each group, ties to the smaller id."""
    order = np.lexsort((id_, -score, group))
    group = group[order]
    head = np.flatnonzero(np.diff(group, prepend=group[:1] - 1))
    place = np.arange(len(group)) - np.repeat(head, np.diff(head, append=len(group)))
    return order[place < k]


def meet(candidates: DataFrame, anchors: DataFrame, n_blocks: int, found: Callable, schema: str) -> DataFrame:
    """`found(candidates, anchors)` of every block of anchors beside every block of candidates.

    Each of the few blocks of anchors is repeated per block number of the candidates and both sides
    meet by that number. Blocks of different lengths of vectors are not compared.
    """
    fields = [c.split()[0] for c in BLOCK.split(", ")]
    if not n_blocks:
        return candidates.sparkSession.createDataFrame([], schema)
    each = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), *[F.col(c).alias(f"a_{c}") for c in fields])
    tasks = max(1, min(TASKS, n_blocks))
    both = candidates.select("block", *fields).repartition(tasks, "block").join(each.repartition(tasks, "block").hint("merge"), "block")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                yield found(Block(*(row[c] for c in fields)), Block(*(row[f"a_{c}"] for c in fields)))

    return both.filter("width = a_width").mapInPandas(run, schema)


def same_label(k: int) -> Callable[[Block, Block], pd.DataFrame]:
    """The k best other rows of each anchor's label."""

    def found(rows: Block, anchors: Block) -> pd.DataFrame:
        scores = products(anchors.vectors, rows.vectors)
        at, of = np.nonzero((anchors.labels[:, None] == rows.labels) & (anchors.ids[:, None] != rows.ids))
        score, id_ = scores[at, of], rows.ids[of]
        top = best(at, score, id_, k)
        return pd.DataFrame({"number": anchors.numbers[at[top]], "id": id_[top], "score": score[top]})

    return found


def slots(k: int) -> Callable[[Block, Block], pd.DataFrame]:
    """The k best rows of another label in each slot of each anchor.

    An anchor's limits are its lowest wanted score, then the windows' upper limits (ascending). A
    score's slot is the number of upper limits below it; scores above all of them have none.
    """

    def found(rows: Block, anchors: Block) -> pd.DataFrame:
        scores = products(anchors.vectors, rows.vectors)
        inside = (scores >= anchors.limits[:, :1]) & (scores <= anchors.limits[:, -1:])
        at, of = np.nonzero(inside & (anchors.labels[:, None] != rows.labels))
        score, id_ = scores[at, of], rows.ids[of]
        slot = np.zeros(len(at), np.int64)
        for j in range(1, anchors.limits.shape[1]):
            slot += score > anchors.limits[at, j]
        top = best(at * anchors.limits.shape[1] + slot, score, id_, k)
        return pd.DataFrame({"number": anchors.numbers[at[top]], "slot": slot[top], "id": id_[top], "score": score[top]})

    return found


def first(rows: DataFrame, k: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "id")
    return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _percent(score: str, percent: int, up: bool) -> Column:
    """floor (or ceiling) of percent/100 of a score; whole numbers that stay below the score's size."""
    return F.expr(
        f"({score} - pmod({score}, 100)) div 100 * {percent} + (pmod({score}, 100) * {percent} + {99 if up else 0}) div 100"
    )


def hard_negatives(
    df: DataFrame, anchors: DataFrame, k: int = 5, positives: int = 5, low_percent: int = 80, high_percent: int = 100,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: float = 256.0,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Scores are inner products of floor(scale * x). An anchor's positives are its best `positives` other
    rows of its label; its negatives for a positive are the best `k` rows of other labels whose score
    lies between `low_percent` and `high_percent` of the positive's. Ties go to the smaller id; a pair
    with fewer rows has fewer, a pair without any has none.

    `anchors` are rows of `df` (same columns). Rows with a NULL id, label or vector, or with a NULL, NaN
    or infinite component take no part. A row is no positive of an anchor with its id. Vectors of
    different lengths are not compared. Repeated rows are candidates each; a repeated anchor counts
    once, and of different anchors with one id each has its own positives. Labels are compared by their
    64-bit hashes. Empty tables give no rows. Other columns are not read.
    """

    def usable(rows: DataFrame) -> DataFrame:
        picked = frames.pick(rows, id=id_col, label=label_col, vector=vector_col).dropna()
        return picked.select(F.col("id").cast("long").alias("id"), F.xxhash64("label").alias("label"), "vector")

    none = F.array().cast("array<long>")
    packed = blocks(usable(df).withColumns({"number": F.lit(0).cast("long"), "limits": none}), scale, ROWS)
    candidates, n_blocks = _numbered(packed)
    asked = frames.stored(usable(anchors).distinct().withColumn("number", F.monotonically_increasing_id()), "anchors")

    def near(limited: DataFrame, found: Callable, schema: str) -> DataFrame:
        return meet(candidates, frames.stored(blocks(limited, scale, ANCHORS), "anchor-blocks"), n_blocks, found, schema)

    close = near(asked.withColumn("limits", none), same_label(positives), "number long, id long, score long")
    owned = frames.stored(
        first(close, positives, "number").select(
            "number", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
            _percent("score", low_percent, True).alias("low"), _percent("score", high_percent, False).alias("high"),
        ).filter("low <= high"),
        "positives",
    )
    # A fixed number of limits: the lowest one stands in for those of missing positives.
    ends = owned.groupBy("number").agg(F.min("low").alias("least"), F.sort_array(F.collect_list("high")).alias("highs"))
    padded = F.concat(F.array("least"), F.array_repeat(F.col("highs")[0], F.lit(positives) - F.size("highs")), "highs")
    limited = asked.join(ends.select("number", padded.alias("limits")), "number")
    slotted = first(near(limited, slots(k), "number long, slot long, id long, score long"), k, "number", "slot")
    # At most `k` rows a slot: descending scores of all slots of an anchor. A window's rows are a suffix.
    falling = slotted.groupBy("number").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("below"), "id"))).alias("falling")
    )
    window = F.slice(F.filter("falling", lambda x: -x["below"] <= F.col("high")), 1, k)
    answers = owned.join(falling, "number").select("*", F.posexplode(window).alias("at", "found"))
    return (
        answers.filter(-F.col("found.below") >= F.col("low"))
        .join(asked.select("number", F.col("id").alias("anchor_id")), "number")
        .select(
            "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("found.id").alias("negative_id"),
            "positive_score", (-F.col("found.below")).alias("negative_score"),
        )
    )


def _numbered(packed: DataFrame) -> tuple[DataFrame, int]:
    """The blocks, stored, with numbers from 0 on in `block`; and how many there are."""
    kept = frames.stored(packed.withColumn("made", F.monotonically_increasing_id()), "candidate-blocks")
    # The upper bits are the task: one row per task that made blocks.
    task = F.shiftright("made", 33)
    held = kept.groupBy(task.alias("task")).agg(F.count("*").alias("held"))
    before = F.sum("held").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    bases = held.select("task", F.coalesce(before, F.lit(0)).alias("base"))
    numbered = kept.join(F.broadcast(bases), task == F.col("task"))
    return numbered.withColumn("block", (F.col("base") + F.col("made").bitwiseAND((1 << 33) - 1)).cast("int")), kept.count()
