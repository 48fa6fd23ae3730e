"""Runs (periodic stretches of words) by grammar compression.

A batch of documents is compressed by Re-Pair over word numbers: repeated pairs become rules, the
commonest first, until no pair of a document repeats; what is left of a document becomes a balanced
tree. A run lies in the text of the lowest rule whose boundary it crosses, so looking once at the
boundary of each rule and moving what is found to all places of that rule finds every run. Found
stretches of one period that overlap by the period are parts of one run and are merged.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from outledger.llm import frames

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Shortest run, and words that are compressed together.
LEAST, TOGETHER = 12, 200_000
#: Words that must agree at the boundary before the exact extent is looked up.
SEED = 3
#: Candidate offsets that are looked at together.
CHUNK = 2_000_000


def word_numbers(documents: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """Words of all documents in a row, as numbers (equal words, equal numbers), and where documents begin."""
    flat = list(chain.from_iterable(documents))
    number = dict(zip(dict.fromkeys(flat), count(), strict=False))
    numbers = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    return numbers, np.concatenate([[0], np.cumsum([len(w) for w in documents])]).astype(np.int64)


def _codes(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct row of the columns, in their order, and how often each occurs."""
    code, limit = columns[0], int(columns[0].max(initial=0)) + 1
    for column in columns[1:]:
        width = int(column.max(initial=0)) + 1
        if limit * width >= 1 << 62:
            _, code = np.unique(code, return_inverse=True)
            limit = len(code)
        code, limit = code * width + column, limit * width
    _, code, counts = np.unique(code, return_inverse=True, return_counts=True)
    return code, counts


class Grammar:
    """Rules of a batch: length of the left part and of the whole, and all places (first word) of each.

    `left`, `size` have one entry per rule; `rule`, `place` one per node of the derivation.
    """

    def __init__(self, words: np.ndarray, starts: np.ndarray):
        self._left, self._size, self._rule, self._place, self.rules = [], [], [], [], 0
        n = len(words)
        document = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        at, symbol = np.arange(n), words
        # Symbols that have left the pairing, with their document's rest.
        done_at = []
        while len(at):
            at, symbol, document, rest = self._round(at, symbol, document, starts)
            done_at.append(rest)
        self._trees(np.sort(np.concatenate(done_at)) if done_at else at, starts, n)
        self.left, self.size = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (self._left, self._size))
        self.rule, self.place = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (self._rule, self._place))

    def _add(self, rule: np.ndarray, place: np.ndarray, left: np.ndarray, size: np.ndarray) -> None:
        self._rule.append(rule + self.rules)
        self._place.append(place)
        self._left.append(left)
        self._size.append(size)
        self.rules += len(left)

    def _round(self, at, symbol, document, starts):
        """Replace the pairs that are commoner than both pairs they overlap; ends documents without repeats.

        `at` are the places of the symbols (ascending), `symbol` their numbers. Pairs count inside
        their document. The commonest pair of a document has no commoner neighbour, so each round
        shortens every document that still has a repeated pair.
        """
        # The last symbol of a document ends with it: documents in between may be finished.
        size = np.minimum(np.append(at[1:], starts[-1]), starts[document + 1]) - at
        inner = np.flatnonzero(document[1:] == document[:-1])
        if not len(inner):
            return at[:0], symbol[:0], document[:0], at
        code, counts = _codes(document[inner], symbol[inner], symbol[inner + 1])
        times = counts[code]
        # Overlapping occurrences in a run of one symbol (aaa) are no repeat: every second one is looked at.
        same = symbol[inner] == symbol[inner + 1]
        head = np.ones(len(inner), bool)
        head[1:] = ~(same[1:] & same[:-1] & (inner[1:] == inner[:-1] + 1))
        position = np.arange(len(inner)) - np.maximum.accumulate(np.where(head, np.arange(len(inner)), 0))
        open_ = (times > 1) & (position % 2 == 0)
        busy = np.zeros(int(document[-1]) + 1, bool)
        busy[document[inner[open_]]] = True
        # Commonest first; ties by a mixed number, so that equally common pairs don't form chains.
        mixed = (code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        rank = np.zeros(len(at) + 1, np.float64)
        rank[inner[open_]] = times[open_] * float(1 << 24) + mixed[open_] + 1
        own, before, after = rank[:-1], np.concatenate([[0], rank[:-2]]), rank[1:]
        code_at = np.full(len(at) + 1, -1)
        code_at[inner] = code
        # Equal ranks of neighbours: the earlier one goes first.
        taken = (own > 0) & (own > before) & (own >= after)
        taken = np.flatnonzero(taken)
        rest = at[~busy[document]]
        if not len(taken):
            return at[:0], symbol[:0], document[:0], at
        used, first, rule = np.unique(code_at[taken], return_index=True, return_inverse=True)
        self._add(rule, at[taken], size[taken[first]], size[taken[first]] + size[taken[first] + 1])
        keep = np.ones(len(at), bool)
        keep[taken + 1] = False
        fresh = symbol.copy()
        fresh[taken] = int(symbol.max()) + 1 + rule
        keep &= busy[document]
        _, fresh = np.unique(fresh[keep], return_inverse=True)
        return at[keep], fresh, document[keep], rest

    def _trees(self, at: np.ndarray, starts: np.ndarray, n: int) -> None:
        """Balanced pairing of what is left of each document: one rule per node, each in one place."""
        while len(at):
            document = np.searchsorted(starts, at, side="right") - 1
            head = np.flatnonzero(np.diff(document, prepend=-1))
            position = np.arange(len(at)) - np.repeat(head, np.diff(head, append=len(at)))
            partner = np.zeros(len(at), bool)
            partner[:-1] = document[1:] == document[:-1]
            taken = np.flatnonzero(partner & (position % 2 == 0))
            if not len(taken):
                return
            ends = np.minimum(np.append(at[1:], n)[np.minimum(taken + 1, len(at) - 1)], starts[document[taken] + 1])
            self._add(np.arange(len(taken)), at[taken], at[taken + 1] - at[taken], ends - at[taken])
            keep = np.ones(len(at), bool)
            keep[taken + 1] = False
            at = at[keep]


class Extents:
    """How far two places of a document agree, by numbers of all stretches of 1, 2, 4, ... words.

    Only the documents in `used` (a flag each) are held; places are those among all words.
    """

    def __init__(self, words: np.ndarray, document: np.ndarray, used: np.ndarray):
        self.used, there = used, used[document]
        self.at = np.concatenate([[0], np.cumsum(there)])
        words = words[there]
        longest = int(np.bincount(document[there]).max())
        self.levels = [words]
        while 2 << (len(self.levels) - 1) <= longest:
            step, last = 1 << (len(self.levels) - 1), self.levels[-1]
            pair = last[:-step].astype(np.int64) * (int(last.max()) + 1) + last[step:]
            self.levels.append(np.unique(pair, return_inverse=True)[1].astype(np.int32))

    def forward(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words that agree from i and j on, `most` at most."""
        i, j = self.at[i], self.at[j]
        out = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.levels))):
            level, step = self.levels[k], 1 << k
            fits = np.flatnonzero(out + step <= most)
            equal = fits[level[i[fits] + out[fits]] == level[j[fits] + out[fits]]]
            out[equal] += step
        return out

    def backward(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words that agree before i and j, `most` at most."""
        i, j = self.at[i], self.at[j]
        out = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.levels))):
            level, step = self.levels[k], 1 << k
            fits = np.flatnonzero(out + step <= most)
            equal = fits[level[i[fits] - out[fits] - step] == level[j[fits] - out[fits] - step]]
            out[equal] += step
        return out


def _offsets(words: np.ndarray, low: np.ndarray, middle: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Of each rule (at one of its places): i < j, one beside the boundary, whose next words agree.

    A run of period q across `middle` has 6 agreeing words or more, q apart, around the boundary, so
    SEED of them stand right behind or right before it.
    """
    n = len(words)
    if n < 2 * SEED:
        return
    grams, _ = _codes(*(words[k : n - SEED + 1 + k] for k in range(SEED)))
    order = np.argsort(grams, kind="stable")
    keys = grams[order] * np.int64(n + 1) + order
    for shift in (0, SEED):
        at = middle - shift
        rules = np.flatnonzero((at >= low) & (at + SEED <= high))
        base = grams[at[rules]] * np.int64(n + 1)
        lo = np.searchsorted(keys, base + low[rules])
        hi = np.searchsorted(keys, base + high[rules] - SEED + 1)
        lengths = hi - lo
        several = lengths > 1
        rules, lo, lengths = rules[several], lo[several], lengths[several]
        ends = np.cumsum(lengths)
        begin = 0
        while begin < len(rules):
            end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + CHUNK)))
            part = slice(begin, end)
            _, inside = frames.ragged(lengths[part])
            rule = np.repeat(rules[part], lengths[part])
            other = order[np.repeat(lo[part], lengths[part]) + inside]
            own = middle[rule]
            i = np.minimum(other + shift, own)
            j = np.maximum(other + shift, own)
            apart = i < j
            yield rule[apart], i[apart], j[apart]
            begin = end


def _crossing(words: np.ndarray, starts: np.ndarray, grammar: Grammar, least: int) -> tuple[np.ndarray, ...]:
    """rule, begin (in the rule) and length, and period, of the stretches across each rule's boundary."""
    first = np.full(grammar.rules, len(words), np.int64)
    np.minimum.at(first, grammar.rule, grammar.place)
    low, middle, high = first, first + grammar.left, first + grammar.size
    document = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    found, extents = [], None
    for rule, i, j in _offsets(words, low, middle, high):
        q = j - i
        # Cheap look at up to 2 * SEED words on either side, then the exact extent of those that agree.
        near = np.zeros(len(rule), np.int64)
        for step in (1, -1):
            going = np.ones(len(rule), bool)
            for d in range(2 * SEED):
                a = i + d if step > 0 else i - 1 - d
                b = j + d if step > 0 else j - 1 - d
                going &= (b < high[rule]) if step > 0 else (a >= low[rule])
                going[going] = words[a[going]] == words[b[going]]
                near += going
        kept = np.flatnonzero(near >= 2 * SEED)
        if not len(kept):
            continue
        rule, i, j, q = rule[kept], i[kept], j[kept], q[kept]
        used = np.zeros(len(starts) - 1, bool)
        used[document[low[rule]]] = True
        if extents is None or (used & ~extents.used).any():
            extents = Extents(words, document, used if extents is None else used | extents.used)
        back = extents.backward(i, j, i - low[rule])
        ahead = extents.forward(i, j, high[rule] - j)
        enough = back + ahead >= np.maximum(q, least - q)
        rule, q, begin, length = rule[enough], q[enough], (i - back)[enough], (q + back + ahead)[enough]
        found.append((rule, begin - low[rule], length, q))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def runs(words: np.ndarray, starts: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """begin, length and smallest period of the maximal runs of all documents, by begin and period.

    `words` are word numbers of documents in a row, `starts` where they begin (and the end). A run has
    at least `least` words and two periods.
    """
    if not len(words):
        return tuple(np.empty(0, np.int64) for _ in range(3))
    grammar = Grammar(words, starts)
    rule, inside, length, period = _crossing(words, starts, grammar, max(least, 4 * SEED))
    if not len(rule):
        return tuple(np.empty(0, np.int64) for _ in range(3))
    found = np.unique(np.stack([rule, period, inside, length]), axis=1)
    rule, period, inside, length = found
    # To all places of each rule.
    order = np.argsort(grammar.rule, kind="stable")
    lo = np.searchsorted(grammar.rule[order], rule)
    hi = np.searchsorted(grammar.rule[order], rule, side="right")
    copies = hi - lo
    _, each = frames.ragged(copies)
    begin = grammar.place[order[np.repeat(lo, copies) + each]] + np.repeat(inside, copies)
    end, period = begin + np.repeat(length, copies), np.repeat(period, copies)
    return _merged(begin, end, period)


def _merged(begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of one period that overlap by it become one; of equal stretches that with the least period stays."""
    order = np.lexsort((-end, begin, period))
    begin, end, period = begin[order], end[order], period[order]
    # The furthest end so far, per period: ends are lifted above those of all lower periods.
    lift = np.searchsorted(np.unique(period), period) * np.int64(end.max() + 1)
    reach = np.maximum.accumulate(end + lift) - lift
    head = np.ones(len(begin), bool)
    head[1:] = (period[1:] != period[:-1]) | (begin[1:] > reach[:-1] - period[1:])
    first = np.flatnonzero(head)
    begin, end, period = begin[first], np.maximum.reduceat(end, first), period[first]
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    least = np.ones(len(begin), bool)
    least[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    begin, end, period = begin[least], end[least], period[least]
    order = np.lexsort((period, begin))
    return begin[order], (end - begin)[order], period[order]


def _batches(texts: Iterator[list], together: int) -> Iterator[list[list]]:
    held, n = [], 0
    for words in texts:
        held.append(words)
        n += len(words)
        if n >= together:
            yield held
            held, n = [], 0
    if held:
        yield held


def described(documents: list[list[str]], least: int = LEAST) -> list[dict]:
    """Of each document its runs and the text without repeated periods."""
    words, starts = word_numbers(documents)
    begin, length, period = runs(words, starts, least)
    owner = np.searchsorted(starts, begin, side="right") - 1
    edges = np.searchsorted(owner, np.arange(len(documents) + 1))
    out = []
    for k, own in enumerate(documents):
        part = slice(edges[k], edges[k + 1])
        b, n, q = begin[part] - starts[k], length[part], period[part]
        kept = own
        if len(b):
            # Covered by the part of a run behind its first period.
            cover = np.zeros(len(own) + 1, np.int64)
            np.add.at(cover, b + q, 1)
            np.add.at(cover, b + n, -1)
            kept = [own[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0)]
        out.append({"runs": np.stack([b, n, q], axis=1), "collapsed": " ".join(kept)})
    return out


def periodic_runs(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, words=None, texts: bool = True
) -> DataFrame:
    """Of every row the runs of its words and the text without repeated periods.

    doc_id, n_runs, start, length, period and exponent_milli of the longest run (ties: smallest start,
    then period; NULL without a run), runs_sha256 and collapsed_sha256, and with `texts` also runs (an array of
    start, length, period) and collapsed. A run is a maximal stretch of words with smallest period q
    and at least max(`least`, 2q) words; `least` must be 12 or more. Words are runs of anything but
    ASCII white space; collapsed text leaves out what lies in a run behind its first period.
    `words(doc_id, words)` may replace the words of a document first.

    NULL and empty texts have no words and no run. NULL ids and repeated rows are kept, each row by
    itself; other columns are not read; an empty table gives no rows. A text is handled in one piece
    in memory, some hundred bytes a word.
    """
    if least < 4 * SEED:
        raise ValueError(f"least must be {4 * SEED} or more")
    rows = frames.pick(df, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["doc_id"]
            split = ([] if t is None else WORD.findall(t) for t in batch["text"])
            if words:
                split = (words(None if pd.isna(k) else int(k), w) for k, w in zip(ids, split, strict=True))
            at = 0
            for documents in _batches(split, TOGETHER):
                found = described(documents, least)
                yield _rows(ids.iloc[at : at + len(found)], found, texts)
                at += len(found)

    numbers = "n_runs long, start long, length long, period long, exponent_milli long"
    more = ", runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string" if texts else ""
    return rows.mapInPandas(run, f"doc_id {kind}, {numbers}, runs_sha256 string, collapsed_sha256 string{more}")


def _rows(ids: pd.Series, found: list[dict], texts: bool) -> pd.DataFrame:
    longest = []
    for f in found:
        # Runs come by start, then period: the first of the longest is wanted.
        b, n, q = f["runs"][f["runs"][:, 1].argmax()].tolist() if len(f["runs"]) else (None, None, None)
        longest.append((len(f["runs"]), b, n, q, None if b is None else 1000 * n // q))
    out = pd.DataFrame(longest, columns=["n_runs", "start", "length", "period", "exponent_milli"], dtype="Int64")
    out.insert(0, "doc_id", ids.to_numpy())
    listed = ["".join(f"{b},{n},{q}\n" for b, n, q in f["runs"].tolist()) for f in found]
    out["runs_sha256"] = [hashlib.sha256(s.encode()).hexdigest() for s in listed]
    out["collapsed_sha256"] = [hashlib.sha256(f["collapsed"].encode("utf-8", "replace")).hexdigest() for f in found]
    if texts:
        out["runs"] = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in f["runs"].tolist()] for f in found]
        out["collapsed"] = [f["collapsed"] for f in found]
    return out
