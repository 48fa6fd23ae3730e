"""Near duplicates: most links by an LSH forest, those between its groups by an exact prefix join."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from outledger.llm import frames
from outledger.llm.components import connected
from outledger.llm.membership import maybe_in, mixed

#: Trees and hash values per tree: a pair is a candidate where it shares SHORTEST values or more.
TREES, DEPTH, SHORTEST = 20, 7, 3
#: Trees looked at first; the others then look for pairs of different groups only.
FIRST_TREES = 3
#: Earlier rows of the sorted order that each row is compared with, besides the heads of its regions.
WINDOW = 3
#: Documents whose shingles are counted (every SHARE-th, at least SAMPLE), the count from which a shingle
#: is frequent, the most frequent ones told to all tasks, and the parts into which each of these is dealt.
SHARE, SAMPLE, OFTEN, TOLD, SALTS = 16, 4_000, 3, 400_000, 32
#: Least width of parity bits; at that width they go with every prefix row.
FOLDED = 256
WORDS = ["w0", "w1", "w2", "w3"]
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWERED = np.arange(256, dtype=np.uint64)
LOWERED[ord("A") : ord("Z") + 1] += 32


def _powers(n: int, base: np.uint64) -> np.ndarray:
    return np.cumprod(np.full(n, base, np.uint64)) if n else np.empty(0, np.uint64)


_POWERS = _powers(1 << 12, np.uint64(0xD6E8FEB86659FD93))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words, A-Z as a-z; words are runs without ASCII white space."""
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    word = ~SPACES[raw]
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    offsets, inside = frames.ragged(lengths)
    longest = int(lengths.max())
    powers = _POWERS if longest <= len(_POWERS) else _powers(longest, _POWERS[0])
    terms = (LOWERED[raw[word]] + np.uint64(1)) * powers[inside]
    return mixed(np.add.reduceat(terms, offsets) ^ (lengths.astype(np.uint64) << np.uint64(48)))


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of `size` words in a row; fewer words are one sequence."""
    words = word_hashes(text or "")
    if len(words) == 0:
        return words
    width = min(size, len(words))
    out = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        out = out * MULTIPLIER + words[k : k + len(out)]
    return np.unique(mixed(out + np.uint64(width)))


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    a = rng.integers(0, 2**63, n, np.uint64) << np.uint64(1) | np.uint64(1)
    return a, rng.integers(0, 2**63, n, np.uint64)


def signature(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """16 mixed bits of the least value of each permutation."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(found), 1024):
        np.minimum(least, (found[k : k + 1024, None] * a + b).min(axis=0), out=least)
    return (least * MULTIPLIER >> np.uint64(48)).astype(np.uint16)


def parity(found: np.ndarray) -> np.ndarray:
    """A bit per residue of the hashes: whether an odd number of them has it.

    The bits that differ between two sets number at most the elements in one set only, so too many of
    them rule a pair out for certain. A set has one to two bits an element, FOLDED at least; half the bits
    folded onto the other half are the bits of the smaller width.
    """
    bits = max(FOLDED, 1 << max(0, len(found) - 1).bit_length())
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little")


def folded(bits: np.ndarray) -> list[int]:
    """Parity bits at the least width, as four whole numbers."""
    words = bits.view(np.int64)
    while len(words) > FOLDED // 64:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words.tolist()


def apart(one: bytes, other: bytes) -> int:
    """Bits that differ, at the width of the smaller set: a lower bound of the elements in one set only."""
    x, y = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def frequent(docs: DataFrame, n_docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are frequent in a sample that grows with the table (ascending), and their counts there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(text, size) for text in batch["text"]]
            found, counts = np.unique(np.concatenate(sets) if sets else np.empty(0, np.uint64), return_counts=True)
            yield pd.DataFrame({"shingle": found.view(np.int64), "n": counts})

    one_of = max(1, min(SHARE, n_docs // SAMPLE))
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(one_of)) == 0)
    counts = sample.mapInPandas(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = counts.filter(F.col("n") >= OFTEN).orderBy(F.desc("n"), "shingle").limit(TOLD).toPandas()
    values = rows["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(values)
    return values[order], rows["n"].to_numpy(np.int64)[order]


def prefix(found: np.ndarray, often: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The first shingles of a set, in one order for all sets (rare ones, then by hash), and how many are rare.

    Two sets with `percent` of their union in common share at least that part of either one, so they
    share a shingle of these prefixes, whatever the order is.
    """
    n = len(found)
    rank = np.zeros(n, np.int64)
    if len(often):
        at = np.minimum(np.searchsorted(often, found), len(often) - 1)
        rank = np.where(often[at] == found, counts[at], 0)
    length = max(0, min(n, n - (percent * n + 99) // 100 + 1))
    rare = np.flatnonzero(rank == 0)
    if len(rare) >= length:
        # Hashes ascend already.
        return found[rare[:length]], length
    order = np.lexsort((found, rank))[:length]
    return found[order], len(rare)


def profiles(docs: DataFrame, size: int, percent: int, n_docs: int) -> DataFrame:
    """One row per document: doc_id, n_shingles, and of a set that isn't empty its digest, MinHash
    signature, parity bits and the keys of its prefix (40 bits of a shingle each; `rare` of them are rare)."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent(docs, n_docs, size))

    def of(text: str | None, a: np.ndarray, b: np.ndarray) -> tuple:
        found = shingles(text, size)
        if not len(found):
            return 0, None, None, None, None, 0, None, None, None, None
        first, rare = prefix(found, *sent.value, percent)
        keys = (first >> np.uint64(24)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:]
        digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
        # Big-endian: the order of the bytes is the order of the values.
        values = signature(found, a, b).astype(">u2").tobytes()
        bits = parity(found)
        return len(found), digest, values, bits.tobytes(), keys.tobytes(), rare, *folded(bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = _permutations(TREES * DEPTH)
        for batch in batches:
            rows = pd.DataFrame(
                [of(text, a, b) for text in batch["text"]],
                columns=["n_shingles", "digest", "signature", "bits", "keys", "rare", *WORDS],
            ).astype(dict.fromkeys(WORDS, "Int64"))
            rows.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield rows

    return docs.mapInPandas(
        run,
        "doc_id long, n_shingles long, digest binary, signature binary, bits binary, keys binary, rare int, "
        + ", ".join(f"{w} long" for w in WORDS),
    )


def _neighbours(
    ids: np.ndarray, groups: np.ndarray, trees: np.ndarray, keys: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of rows of different groups in sorted order: close rows, and the heads of shared regions.

    A region of depth d is a run of rows with the same first d values. A row is paired with the rows
    just before it and with the first row of its region at each depth from SHORTEST to the longest
    prefix it shares with the row before; so dense regions are compared at greater depth.
    """
    n = len(ids)
    same = np.zeros((n, DEPTH + 1), bool)  # column d: first d values as in the row before
    same[1:, 0] = trees[1:] == trees[:-1]
    for d in range(DEPTH):
        same[1:, d + 1] = same[1:, d] & (keys[1:, d] == keys[:-1, d])
    at = np.arange(n)
    left, right = [], []
    for d in range(SHORTEST, DEPTH + 1):
        head = np.maximum.accumulate(np.where(same[:, d], 0, at))
        rows = np.flatnonzero(same[:, d])
        left.append(head[rows])
        right.append(rows)
        if d == SHORTEST:
            for back in range(1, WINDOW + 1):
                rows = np.flatnonzero(at - head >= back)
                left.append(rows - back)
                right.append(rows)
    left, right = np.concatenate(left), np.concatenate(right)
    keep = groups[left] != groups[right]
    a, b = ids[left], ids[right]
    return np.minimum(a, b)[keep], np.maximum(a, b)[keep]


#: Rows that are looked at together; the last rows and all open heads go on to the next.
CHUNK = 50_000


def _tree_rows(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(batch["prefix"]), ">u2").reshape(len(batch), DEPTH)
    numbers = (batch[c].to_numpy(np.int64) for c in ("doc_id", "component", "tree"))
    return *numbers, raw.astype(np.uint16)


def _carried(trees: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Rows that later ones may be paired with: the open regions' heads and the last few rows."""
    last = len(trees) - 1
    open_ = np.flatnonzero(trees == trees[last])
    out = set(range(max(0, last - WINDOW + 1), last + 1))
    for d in range(SHORTEST, DEPTH + 1):
        match = open_[(keys[open_, :d] == keys[last, :d]).all(axis=1)]
        out.add(int(match[0]))
    return np.array(sorted(out))


def candidates(rows: DataFrame, partitions: int, first: int = 0, last: int = TREES) -> DataFrame:
    """Distinct pairs a < b of different components that are neighbours in the sorted order of a tree.

    `rows` (doc_id, component, signature) has one row per distinct shingle set; trees `first` to `last` - 1
    are looked at. The orders are dealt by range, document id included, so that no region is bound to one
    task. Each task also hands out its first and last rows; these few are compared across the task borders.
    """
    trees = F.transform(
        F.sequence(F.lit(first), F.lit(last - 1)),
        lambda t: F.struct(t.alias("tree"), F.substring("signature", t * (2 * DEPTH) + 1, F.lit(2 * DEPTH)).alias("prefix")),
    )
    each = rows.select("doc_id", "component", F.inline(trees))
    ordered = each.repartitionByRange(partitions, "tree", "prefix", "doc_id").sortWithinPartitions(
        "tree", "prefix", "doc_id"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, edge = None, []
        for batch in batches:
            for k in range(0, len(batch), CHUNK):
                own = _tree_rows(batch.iloc[k : k + CHUNK])
                if kept is None:
                    edge.append(tuple(x[:WINDOW] for x in own))
                else:
                    own = tuple(np.concatenate(x) for x in zip(kept, own, strict=True))
                a, b = _neighbours(*own)
                yield pd.DataFrame({"a": a, "b": b, "component": None, "tree": None, "prefix": None}).drop_duplicates()
                left = _carried(own[2], own[3])
                kept = tuple(x[left] for x in own)
        if kept is not None:
            edge.append(kept)
            ids, groups, trees, keys = (np.concatenate(x) for x in zip(*edge, strict=True))
            yield pd.DataFrame({
                "a": ids, "b": ids, "component": groups, "tree": trees, "prefix": [k.astype(">u2").tobytes() for k in keys],
            }).drop_duplicates()

    found = frames.stored(
        ordered.mapInPandas(run, "a long, b long, component long, tree int, prefix binary"), "forest"
    )
    inner = found.filter("tree is null").select("a", "b")

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = list(batches)
        if sum(map(len, rows)):
            every = pd.concat(rows)
            a, b = _neighbours(*_tree_rows(every.rename(columns={"a": "doc_id"})))
            yield pd.DataFrame({"a": a, "b": b})

    # A few rows per task of the step before, whatever the size of the table.
    edges = found.filter("tree is not null").select("a", "component", "tree", "prefix").distinct()
    border = edges.coalesce(1).sortWithinPartitions("tree", "prefix", "a").mapInPandas(across, "a long, b long")
    pairs = frames.stored(inner.unionByName(border).distinct(), "candidates")
    frames.discard(found)
    return pairs


def likely(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sizes and parity bits don't rule out; no pair that is a link is lost.

    Sets with `percent` of their union in common differ in at most (100 - percent) of 100 + percent
    parts of their sizes' sum.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lower = np.fromiter(map(apart, batch["bits_a"], batch["bits_b"]), np.int64, len(batch))
            keep = lower * (100 + percent) <= (100 - percent) * batch["total"].to_numpy(np.int64)
            yield batch.loc[keep, ["a", "b"]]

    known = sets.select("doc_id", "n_shingles", "bits")
    near = pairs.join(known.withColumnsRenamed({"doc_id": "a", "n_shingles": "n_a", "bits": "bits_a"}), "a").join(
        known.withColumnsRenamed({"doc_id": "b", "n_shingles": "n_b", "bits": "bits_b"}), "b"
    )
    sized = near.filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    return sized.select("a", "b", (F.col("n_a") + F.col("n_b")).alias("total"), "bits_a", "bits_b").mapInPandas(
        run, "a long, b long"
    )


def texts_of(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The texts of the documents in pairs, and of a few others."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))
    return docs.filter(maybe_in(ids, "doc_id"))


def linked(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full sets have at least `percent` of their union in common."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep, last = [], (None, None)
            for a, text_a, text_b in zip(batch["a"], batch["text_a"], batch["text_b"], strict=True):
                if last[0] != a:
                    last = (a, shingles(text_a, size))
                one, other = last[1], shingles(text_b, size)
                both = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(other) - both))
            yield batch.loc[keep, ["a", "b"]]

    texts = frames.stored(texts_of(docs, pairs), "pair-texts")
    left = pairs.join(texts.withColumnsRenamed({"doc_id": "a", "text": "text_a"}), "a")
    both = left.join(texts.withColumnsRenamed({"doc_id": "b", "text": "text_b"}), "b")
    links = frames.stored(both.select("a", "b", "text_a", "text_b").mapInPandas(run, "a long, b long"), "links")
    frames.discard(texts)
    return links


def confirmed(pairs: DataFrame, sets: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The links among candidate pairs: by parity bits first, then on full sets."""
    near = frames.stored(likely(pairs, sets, percent), "likely")
    links = linked(near, docs, size, percent)
    frames.discard(near)
    return links


def crossing(heads: DataFrame, groups: DataFrame, placed: DataFrame | None = None) -> DataFrame:
    """key, doc_id, component, n, place, times, shared and later of prefix keys that occur in two groups (components) or more.

    Keys of the same documents are one row each (see `first_keys`), `times` their number; `shared` is the
    number of such keys of the document, `later` that from the row's place on; its folded parity bits come along.
    Frequent keys are looked at in parts, so that none is bound to one task; they pass where a part
    has two groups, or all parts by their least and greatest group together.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(0, len(batch), 2000):
                part = batch.iloc[k : k + 2000]
                lengths = part["keys"].map(len).to_numpy() // 5
                raw = np.zeros((int(lengths.sum()), 8), np.uint8)
                raw[:, 3:] = np.frombuffer(b"".join(part["keys"]), np.uint8).reshape(-1, 5)
                place = frames.ragged(lengths)[1]
                ids = np.repeat(part["doc_id"].to_numpy(np.int64), lengths)
                often = place >= np.repeat(part["rare"].to_numpy(np.int64), lengths)
                salt = (mixed(ids.view(np.uint64)) % np.uint64(SALTS)).astype(np.int32) + 1
                yield pd.DataFrame({
                    "key": raw.view(">u8").reshape(-1).astype(np.int64), "salt": np.where(often, salt, 0).astype(np.int32),
                    "doc_id": ids, "component": np.repeat(part["component"].to_numpy(np.int64), lengths),
                    "n": np.repeat(part["n_shingles"].to_numpy(np.int32), lengths), "place": place.astype(np.int32),
                })

    grouped = (heads if placed is None else placed).select("doc_id", "n_shingles", "keys", "rare").join(groups, "doc_id")
    each = grouped.select("doc_id", F.col("n_shingles").cast("int"), "keys", "rare", "component").mapInPandas(
        run, "key long, salt int, doc_id long, component long, n int, place int"
    )
    of_key = Window.partitionBy("key", "salt")
    seen = each.withColumns({"low": F.min("component").over(of_key), "high": F.max("component").over(of_key)})
    rows = frames.stored(seen.filter("salt > 0 or low < high"), "prefix-rows")
    # Parts of a frequent key meet by their least and greatest group only.
    kept = frames.stored(first_keys(rows), "first-keys")
    met = rows.select("key", "doc_id", "component", "n", "place").join(kept, "key")
    out = frames.stored(_counted(met, heads), "crossing")
    frames.discard(rows, kept)
    return out


def first_keys(rows: DataFrame) -> DataFrame:
    """key and times: of all keys that the same documents share, the first in the order of the prefixes, and their number.

    A passage that two documents share gives them hundreds of keys, which would all find the same pair. Only keys of
    two groups count. Documents of a key are told by two 64-bit hashes, their number and the ends of their ids;
    nothing is gathered by key but these numbers.
    """
    of_key = rows.groupBy("key").agg(
        F.count("*").alias("docs"), F.max("doc_id").alias("last"), F.min(F.struct("doc_id", "place")).alias("at"),
        F.bit_xor(F.xxhash64("doc_id")).alias("hash"), F.bit_xor(F.xxhash64("doc_id", F.lit(1))).alias("other_hash"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    ).filter("low < high")
    # Places in one document follow the common order.
    same = of_key.groupBy("docs", "at.doc_id", "last", "hash", "other_hash").agg(
        F.min(F.struct("at.place", "key")).alias("first"), F.count("*").cast("int").alias("times")
    )
    return same.select("first.key", "times")


def _counted(rows: DataFrame, heads: DataFrame) -> DataFrame:
    # Both sides meet by document, where the rows are then counted.
    with_bits = rows.join(heads.select("doc_id", *WORDS).hint("merge"), "doc_id")
    of_doc = Window.partitionBy("doc_id")
    # Rows of one place count for each other.
    later = of_doc.orderBy(F.desc("place")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return with_bits.withColumns({
        "shared": F.sum("times").over(of_doc).cast("int"), "later": F.sum("times").over(later).cast("int"),
    })


def across_groups(rows: DataFrame, others: DataFrame, percent: int, whole: bool) -> DataFrame:
    """Distinct pairs a < b of a key, of two groups, that can have enough in common.

    A pair is looked for at the first key it shares: what either set has before it isn't in the other. Of two
    sets, the keys of the prefix that ends first are in the other set only where they are in its prefix: so
    the keys from there on that set shares with no other group are lacking. Which of the two ends first isn't
    looked at; the weaker bound counts. Parity bits bound what is in one set only. A linked pair meets all bounds at
    its first key. `whole` says that `others` has all rows of the keys; a pair is then met from its lower id alone.
    """
    n = F.col("n").cast("long")
    length = F.greatest(F.lit(0), F.least(n, n - F.ceil(n * percent / 100) + 1))
    sized = lambda df: df.withColumns({"ahead": n - F.col("place"), "most": n - length + F.col("later")})
    names = ("doc_id", "component", "n", "ahead", "most", *WORDS)
    own = sized(rows).select("key", *names)
    other = sized(others).select("key", *[F.col(c).alias(f"_{c}") for c in names])
    total = n + F.col("_n")
    reach = F.least("ahead", "_ahead", F.greatest("most", "_most"))
    differ = sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"_{w}"))) for w in WORDS), F.lit(0)).cast("long")
    met = (F.col("component") != F.col("_component")) & (reach * (100 + percent) >= total * percent)
    if whole:
        met = met & (F.col("doc_id") < F.col("_doc_id"))
    pairs = own.join(other, "key").filter(met & (differ * (100 + percent) <= total * (100 - percent)))
    return pairs.select(F.least("doc_id", "_doc_id").alias("a"), F.greatest("doc_id", "_doc_id").alias("b")).distinct()


def centres(rows: DataFrame) -> DataFrame:
    """One row of each key: of the document that shares the most keys."""
    best = F.max(F.struct("shared", "doc_id", "component", "n", "place", "later", *WORDS)).alias("best")
    return rows.groupBy("key").agg(best).select("key", "best.*")


def merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """The groups after links between their members."""
    ends = links.join(groups.withColumnsRenamed({"doc_id": "a", "component": "_a"}), "a").join(
        groups.withColumnsRenamed({"doc_id": "b", "component": "_b"}), "b"
    )
    labels = connected(ends.select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct())
    further = labels.select(F.col("node").alias("component"), F.col("component").alias("lower"))
    joined = groups.join(further, "component", "left")
    return frames.stored(joined.select("doc_id", F.coalesce("lower", "component").alias("component")), "groups")


def completed(
    groups: DataFrame, heads: DataFrame, docs: DataFrame, size: int, percent: int, placed: DataFrame | None = None
) -> DataFrame:
    """The groups after every link between two of them.

    First each document is compared with the centres of its keys, which brings most members of a
    dense group together; then all pairs that still lie in two groups and share a key. `placed` has the rows
    of `heads` in buckets by document.
    """
    rows = crossing(heads, groups, placed)
    for step in ("centres", "all"):
        if rows.isEmpty():
            break
        others = centres(rows) if step == "centres" else rows
        pairs = frames.stored(across_groups(rows, others, percent, step == "all"), "crossing-pairs")
        links = confirmed(pairs, heads, docs, size, percent)
        frames.discard(pairs)
        if not links.isEmpty():
            groups = merged(groups, links)
            if step == "centres":
                renewed = frames.stored(rows.drop("component", "shared", "later", *WORDS).join(groups, "doc_id"), "crossing")
                spans = renewed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                still = spans.filter("low < high").select("key")
                frames.discard(rows)
                rows = frames.stored(_counted(renewed.join(still, "key", "left_semi"), heads), "crossing")
                frames.discard(renewed)
    frames.discard(rows)
    return groups


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Documents are linked where their sets of distinct `size`-word shingles have at least `percent`
    of the union in common; component_id is the smallest id that can be reached. Equal sets are one
    class from the start. Every link is confirmed on full sets (64-bit shingle hashes). The forest
    finds most links; a prefix-filtered join then finds every link between two of its groups, so the
    components are those of an exact join.

    NULL and empty texts, and texts of white space, have the empty set and are linked with nothing.
    A row with a NULL id is kept, unlinked, with a NULL component. Rows that share an id are
    kept, each in the component of its own text. An empty table gives no rows. Ids must be whole numbers.
    """
    docs = frames.pick(df, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = frames.stored(profiles(docs, size, percent, docs.count()), "profiles")
    classes = frames.stored(
        rows.filter("digest is not null and doc_id is not null")
        .groupBy("digest").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("members")),
        "classes",
    )
    # Only sets that occur more than once need a look-up of their class.
    several = classes.filter("members > 1").select("digest", "class_id")
    known = frames.stored(
        rows.select("doc_id", "n_shingles", "digest").join(several, "digest", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id")),
        "class-members",
    )
    # The first document of each class stands for it. Few rows may be others: only these meet the list of others.
    later = frames.stored(
        rows.select("doc_id", "digest").join(several, "digest").filter("doc_id <> class_id").select("doc_id", "digest"), "later"
    )
    seen = rows.filter("digest is not null and doc_id is not null").withColumn("_maybe", maybe_in(later, "doc_id"))
    firsts = seen.filter("_maybe").join(later, ["doc_id", "digest"], "left_anti")
    # Signatures and keys, most of the bytes, lie by document and stay there when its group is added.
    heads, placed = frames.stored_by(seen.filter("not _maybe").unionByName(firsts).drop("_maybe"), "heads", "doc_id")
    frames.discard(rows, classes, later)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = heads.select("doc_id", "signature", F.col("doc_id").alias("component"))
    pairs = candidates(rows, partitions, 0, FIRST_TREES)
    links = confirmed(pairs, heads, docs, size, percent)
    ends = connected(links).withColumnRenamed("node", "doc_id")
    groups = frames.stored(
        heads.select("doc_id").distinct().join(ends, "doc_id", "left")
        .select("doc_id", F.coalesce("component", "doc_id").alias("component")),
        "groups",
    )
    frames.discard(pairs, links)
    pairs = candidates(placed.select("doc_id", "signature").join(groups, "doc_id"), partitions, FIRST_TREES)
    links = confirmed(pairs, heads, docs, size, percent)
    if not links.isEmpty():
        groups = merged(groups, links)
    groups = completed(groups, heads, docs, size, percent, placed)
    frames.discard(heads, pairs, links)
    labels = groups.filter("doc_id <> component").withColumnRenamed("doc_id", "node")
    return (
        known.join(labels, known["class_id"] == labels["node"], "left")
        .withColumn("component_id", F.coalesce("component", "class_id"))
        .select(
            "doc_id", "n_shingles", "component_id",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )
