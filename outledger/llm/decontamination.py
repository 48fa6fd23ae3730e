"""Benchmark passages in documents, found by Wu-Manber search over words."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from outledger.llm import frames

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Words of a block; the last block of a window decides how far the search may jump.
BLOCK = 2

RESULT = (
    "doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, "
    "contaminated boolean"
)


def words(text: str | None) -> list[str]:
    return WORDS.findall((text or "").translate(LOWER))


class Shifts:
    """Search machine for patterns of one length.

    `shift` has, for each block of words in a pattern, the smallest distance from the pattern's end;
    any other block lets the window jump past itself. Blocks at a pattern's end lead to a bucket of
    patterns keyed by that suffix; each is compared word by word.
    """

    def __init__(self, patterns: dict[tuple[str, ...], list[str]]):
        self.length = len(next(iter(patterns)))
        self.block = min(BLOCK, self.length)
        self.jump = self.length - self.block + 1
        self.shift: dict[tuple[str, ...], int] = {}
        self.bucket: dict[tuple[str, ...], list[tuple[list[str], list[str]]]] = defaultdict(list)
        for pattern, items in patterns.items():
            for end in range(self.block, self.length + 1):
                key, far = pattern[end - self.block : end], self.length - end
                if far < self.shift.get(key, self.jump):
                    self.shift[key] = far
            self.bucket[pattern[-self.block :]].append((list(pattern), items))

    def find(self, text: list[str]) -> Iterator[tuple[int, list[str]]]:
        """Begin of each occurrence, and the items of the pattern."""
        end, last, block, length = self.length, len(text), self.block, self.length
        shift, jump = self.shift.get, self.jump
        while end <= last:
            key = tuple(text[end - block : end])
            far = shift(key, jump)
            if far:
                end += far
                continue
            window = text[end - length : end]
            for pattern, items in self.bucket[key]:
                if pattern == window:
                    yield end - length, items
            end += 1


class Searcher:
    """One machine per pattern length, so that short items don't shorten all jumps."""

    def __init__(self, patterns: list[tuple[list[str], list[str]]]):
        by_length: dict[int, dict[tuple[str, ...], list[str]]] = defaultdict(dict)
        for pattern, items in patterns:
            by_length[len(pattern)][tuple(pattern)] = items
        self.machines = [Shifts(p) for p in by_length.values()]

    def search(self, text: list[str]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges that occurrences cover (disjoint, ascending) and the items found."""
        spans, items = [], set()
        for machine in self.machines:
            for at, of in machine.find(text):
                spans.append((at, at + machine.length))
                items.update(of)
        merged: list[tuple[int, int]] = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return merged, items


def windows(items: DataFrame, item_col: str, text_col: str, size: int) -> DataFrame:
    """Distinct windows of the items: pattern (words) and the item ids that have it, as text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, text in zip(batch["item"], batch["text"], strict=True):
                found = words(text)
                for k in range(max(1, len(found) - size + 1) if found else 0):
                    rows.append((item, " ".join(found[k : k + size])))
            yield pd.DataFrame(rows, columns=["item", "pattern"])

    named = frames.pick(items, item=item_col, text=text_col).withColumn("item", F.col("item").cast("string"))
    each = named.filter(F.col("item").isNotNull()).mapInPandas(run, "item string, pattern string")
    return each.groupBy("pattern").agg(F.sort_array(F.collect_set("item")).alias("items"))


def decontaminate(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = 10,
    patterns_per_pass: int = 200_000,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row.

    A pass sends at most `patterns_per_pass` windows to the executors; a larger benchmark takes
    further passes over the texts, whose hits are brought together by row. NULL and empty texts have
    no words and no hits; items without words, and items with a NULL id, have no windows; repeated
    items share theirs. An empty benchmark marks nothing. Rows with NULL or repeated ids are kept
    as they are; other columns are not read.
    """
    docs = frames.pick(df, doc_id=id_col, text=text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = frames.stored(windows(benchmark, item_col, item_text_col, size), "windows")
    total = found.count()
    if total <= patterns_per_pass:
        patterns = [(r["pattern"].split(" "), list(r["items"])) for r in found.collect()]
        return docs.mapInPandas(_one_pass(docs, patterns), RESULT.format(kind=kind))
    # Every pass reads its own share of the windows; rows are numbered so that hits can be merged.
    passes = -(-total // patterns_per_pass)
    shares = frames.stored(
        found.withColumn("share", F.pmod(F.xxhash64("pattern"), F.lit(2 * passes))), "window-shares"
    )
    rows = frames.stored(docs.withColumn("row", F.monotonically_increasing_id()), "rows")
    hits = None
    for share in range(2 * passes):
        patterns = [
            (r["pattern"].split(" "), list(r["items"]))
            for r in shares.filter(F.col("share") == share).collect()
        ]
        part = rows.mapInPandas(
            _spans(patterns), "row long, spans array<struct<a:long,b:long>>, items array<string>"
        )
        hits = part if hits is None else hits.unionByName(part)
    merged = hits.groupBy("row").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.collect_list("items").alias("items")
    )
    return (
        rows.join(merged.withColumn("items", F.array_sort(F.array_distinct(F.flatten("items")))), "row", "left")
        .mapInPandas(_settled, RESULT.format(kind=kind))
    )


def clean(
    df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", size: int = 10, patterns_per_pass: int = 200_000,
) -> DataFrame:
    """The rows of `df` without a benchmark passage, all columns as they are.

    Rows are told apart by a stored number, not by an id. NULL and empty texts, NULL and repeated ids are no
    special case; an empty benchmark keeps every row.
    """
    number = "_row"
    while number in df.columns:
        number = f"_{number}"
    rows = frames.stored(df.withColumn(number, F.monotonically_increasing_id()), "numbered")
    hit = decontaminate(
        rows, benchmark, number, text_col, item_col, item_text_col, size, patterns_per_pass
    ).filter("contaminated")
    hit = frames.stored(hit.select(F.col("doc_id").alias(number)), "contaminated").hint("merge")
    return rows.join(hit, number, "left_anti").select(*df.columns)


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode("utf-8")).hexdigest()


def _covered(spans) -> int:
    covered, end = 0, 0
    for a, b in sorted(spans):
        covered += max(0, b - max(a, end))
        end = max(end, b)
    return covered


def _frame(ids: pd.Series, n: list[int], hit: list[int], items: list) -> pd.DataFrame:
    return pd.DataFrame({
        "doc_id": ids, "n_words": n, "n_hit": hit, "n_items": [len(i) for i in items],
        "items_sha256": [_digest(i) for i in items], "contaminated": [h > 0 for h in hit],
    })


def _one_pass(docs: DataFrame, patterns: list[tuple[list[str], list[str]]]):
    sent = docs.sparkSession.sparkContext.broadcast(patterns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        searcher = Searcher(sent.value)
        for batch in batches:
            n, hit, items = [], [], []
            for text in batch["text"]:
                found = words(text)
                spans, of = searcher.search(found)
                n.append(len(found))
                hit.append(_covered(spans))
                items.append(of)
            yield _frame(batch["doc_id"], n, hit, items)

    return run


def _spans(patterns: list[tuple[list[str], list[str]]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        searcher = Searcher(patterns)
        for batch in batches:
            rows = []
            for row, text in zip(batch["row"], batch["text"], strict=True):
                spans, of = searcher.search(words(text))
                if spans:
                    rows.append((row, [{"a": a, "b": b} for a, b in spans], sorted(of)))
            yield pd.DataFrame(rows, columns=["row", "spans", "items"])

    return run


def _settled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        n = [len(words(t)) for t in batch["text"]]
        spans = [[] if s is None else [(x["a"], x["b"]) for x in s] for s in batch["spans"]]
        items = [[] if i is None else list(i) for i in batch["items"]]
        yield _frame(batch["doc_id"], n, [_covered(s) for s in spans], items)
