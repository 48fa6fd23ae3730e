"""Token counts by rank-synchronous merging of ragged symbol arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from outledger.llm import frames, pretokens

NO_RANK = np.int32(2**31 - 1)
#: Distinct pre-tokens merged at once, and remembered by a worker before it forgets them all.
BATCH, REMEMBERED = 50_000, 400_000


class Merges:
    """Merge ranks as sorted arrays: a pair is left * 2**32 + right."""

    def __init__(self, path: str):
        model = pretokens.vocabulary(path)["model"]
        vocab = model["vocab"]
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        self.ranks = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.ranks]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.bytes = np.array([vocab[s] for s in pretokens.byte_symbols()], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols left of each piece once no pair of it has a rank.

        All pieces lie in one array. In each round every piece merges all places of its own
        lowest-ranked pair. This equals merging one place at a time, because each symbol is made by
        one merge only: a pair with the new symbol has a higher rank than the merge that made it.
        """
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        counts = lengths.copy()
        symbols = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.repeat(np.arange(len(pieces)), lengths)
        rank = np.full(len(symbols), NO_RANK)  # of the pair that begins here
        ask = np.flatnonzero(piece[:-1] == piece[1:]) if len(piece) else np.array([], np.int64)
        while len(symbols):
            rank[ask] = self.rank(symbols[ask], symbols[ask + 1])
            first = np.flatnonzero(np.diff(piece, prepend=-1))
            size = np.diff(first, append=len(piece))
            lowest = np.minimum.reduceat(rank, first)
            live = lowest != NO_RANK
            counts[piece[first[~live]]] = size[~live]
            keep = np.repeat(live, size)
            if not keep.any():
                break
            best = np.repeat(lowest, size)
            here = keep & (rank == best)
            here = _every_other(here, symbols)
            at = np.flatnonzero(here)
            symbols[at] = self.made[rank[at]]
            keep[at + 1] = False
            stale = here.copy()  # pairs that begin at, or end in, a new symbol
            left = np.flatnonzero(keep)
            symbols, piece, rank, stale = symbols[left], piece[left], rank[left], stale[left]
            stale[:-1] |= stale[1:]
            inner = np.append(piece[:-1] == piece[1:], False)
            rank[~inner] = NO_RANK
            ask = np.flatnonzero(stale & inner)
        return counts


def _every_other(here: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Of places that overlap (a pair of equal symbols, again and again) the 1st, 3rd, 5th."""
    run = np.flatnonzero(here)
    if len(run) < 2:
        return here
    step = np.diff(run, prepend=run[0] - 2) != 1
    start = run[np.flatnonzero(step)[np.cumsum(step) - 1]]
    out = here.copy()
    out[run[(run - start) % 2 == 1]] = False
    return out


@lru_cache(maxsize=4)
def _merges(path: str) -> Merges:
    return Merges(path)


class Counter:
    """Counts of texts; distinct pre-tokens are merged in batches and remembered."""

    def __init__(self, path: str):
        self.path, self.merges, self.known = path, _merges(path), {}
        self.special = pretokens.special_pattern(path)

    def counts(self, texts: list[str]) -> list[int]:
        out, waiting, fresh = [0] * len(texts), [], set()

        def settle() -> None:
            if fresh:
                pieces = list(fresh)
                found = self.merges.count([p.encode("utf-8") for p in pieces])
                self.known.update(zip(pieces, found.tolist(), strict=True))
            known = self.known
            for k, split in waiting:
                out[k] += sum(map(known.__getitem__, split))
            waiting.clear()
            fresh.clear()
            if len(known) > REMEMBERED:
                known.clear()

        held = 0
        for k, text in enumerate(texts):
            parts = self.special.split(text)
            out[k] = len(parts) - 1
            for part in parts:
                split = pretokens.blank_led(part, self.path)
                waiting.append((k, split))
                fresh.update(set(split).difference(self.known))
                held += len(split)
            if len(fresh) >= BATCH or held >= 10 * BATCH:
                settle()
                held = 0
        settle()
        return out


def token_counts(
    df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row.

    `vocabulary` is the path of a byte-level BPE file on every node. Special strings in a text count
    as one token. A NULL text is an empty one: 0 bytes, 0 tokens. NULL ids and repeated rows stay
    as they are; an empty table gives an empty result; other columns are not read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(vocabulary)
        for batch in batches:
            texts = ["" if t is None else t for t in batch["text"]]
            tokens = np.array(counter.counts(texts), np.int64)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"],
                "n_bytes": np.array([len(t.encode("utf-8")) for t in texts], np.int64),
                "n_tokens": tokens,
                "over_limit": tokens > limit,
            })

    rows = frames.pick(df, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
