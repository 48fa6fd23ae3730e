"""Toxicity by a weighted finite-state grammar over clauses."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from outledger.llm import frames

TOKENS = re.compile(r"[^\W\d_]+|[.,;:!?|\n\"]")
#: Words that a worker remembers before it forgets them all.
REMEMBERED = 400_000

# Closed word classes of the four languages; open ones are learned.
TARGETS = "you your yours yourself he she him her they them their du dich dir dein deine ihr euch sie tu toi te vous votre vos il elle ils elles tú ti tus usted ustedes vosotros él ella ellos ellas"
NEGATIONS = "not never no neither nor cannot don didn isn wasn aren won nicht kein keine keinen nie niemals ne pas jamais aucun aucune non nunca jamás ningún ninguna tampoco"
REPORTS = "said says say saying wrote writes claimed claims called quoted quote reported alleged sagte sagt schrieb behauptete nannte zitierte dit disait écrit affirme cité dijo dice decía escribió afirma llamó citó"
INSULTS = "idiot idiots moron morons stupid dumb loser losers worthless pathetic scum trash clown disgusting dummkopf trottel abschaum wertlos erbärmlich crétin imbécile ordure minable imbécil estúpido basura patético"
HARMS = "kill murder hurt destroy shoot stab beat strangle töten umbringen ermorden verletzen tuer assassiner blesser frapper matar asesinar golpear herir"

INTENTS = "will gonna going want wants shall should must deserve deserves let werde wirst wird soll sollte muss verdienst vais vas va veux veut doit dois mérites voy vas va quiero quiere debe debes mereces"
INTENSIFIERS = "very such so complete completely total totally absolute utter real really damn sehr so völlig total echt absolut très si tellement vraiment totalement muy tan totalmente realmente completo completa"

# Labels of words in a clause; INSULT and HARM carry a weight of their own.
OTHER, TARGET, NEGATION, REPORT, INTENT, INTENSIFIER, INSULT, HARM = "otnrmsIT"
READ = OTHER + TARGET + NEGATION + REPORT + INTENT + INTENSIFIER + INSULT + HARM
# What the transducers write. A target behind the word or before it: aimed insult D, aimed harm B.
AIMED = {INSULT: "D", HARM: "B", "S": "E", "X": "A"}
# An insult made stronger, S (aimed: E); a harm that is meant, X (aimed: A).
STRONGER = {INSULT: "S", "D": "E"}
MEANT = {HARM: "X", "B": "A"}
INSULTING, THREATENING = "ISDE", "TXBA"
DENIED = dict.fromkeys(INSULTING, "i") | dict.fromkeys(THREATENING, "h")
REPORTED = dict.fromkeys(INSULTING, "q") | dict.fromkeys(THREATENING, "w") | {"i": "j", "h": "k"}
#: Share of a word's weight that counts, by its final label.
FACTORS = {
    "I": 1.0, "S": 1.2, "D": 1.5, "E": 1.8, "T": 0.5, "X": 1.2, "B": 1.2, "A": 2.0,
    "i": 0.4, "h": 0.1, "q": 0.6, "w": 0.2, "j": 0.3, "k": 0.05,
}


@dataclass
class Transducer:
    """Deterministic and total: (state, label) -> (state, label written, share of weight)."""

    start: object
    arcs: dict = field(default_factory=dict)

    def step(self, state, label):
        return self.arcs[state, label]

    def labels(self) -> set[str]:
        return {label for _, label in self.arcs}


def scope(trigger: str, rewrite: dict[str, str], labels: str, reach: int | None) -> Transducer:
    """After `trigger`, labels are rewritten for `reach` words (None: to the end of the clause)."""
    states = range(2) if reach is None else range(reach + 1)
    out = Transducer(0)
    for state in states:
        for label in labels:
            after = max(0, state - 1) if reach is not None else state
            written = rewrite.get(label, label) if state else label
            out.arcs[state, label] = ((reach or 1) if label == trigger else after, written, 1.0)
    return out


def weights(labels: str) -> Transducer:
    """One state: each label's share of its word's weight."""
    return Transducer(0, {(0, x): (0, x, FACTORS.get(x, 0.0)) for x in labels})


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The labels that `first` writes are read by `second`; shares multiply."""
    out = Transducer((first.start, second.start))
    todo, seen = [out.start], {out.start}
    while todo:
        a, b = state = todo.pop()
        for label in first.labels():
            a2, middle, w1 = first.step(a, label)
            b2, written, w2 = second.step(b, middle)
            out.arcs[state, label] = ((a2, b2), written, w1 * w2)
            if (a2, b2) not in seen:
                seen.add((a2, b2))
                todo.append((a2, b2))
    return out


def machines() -> tuple[Transducer, list[Transducer]]:
    """The target machine that reads a clause from its end, and those that read it from its start, in order.

    From the end: a target up to 4 words behind an insult or harm aims it. From the start: insults after
    an intensifier, harm after words of intent, denial, reported speech, and targets before the word.
    """
    behind = scope(TARGET, {INSULT: "D", HARM: "B"}, READ, 4)
    read = READ + "DB"
    insult = scope(INTENSIFIER, STRONGER, read, 2)
    read += "SE"
    threat = scope(INTENT, MEANT, read, 4)
    read += "XA"
    denial = scope(NEGATION, DENIED, read, 3)
    read += "ih"
    report = scope(REPORT, REPORTED, read, None)
    read += "qwjk"
    target = scope(TARGET, AIMED, read, 4)
    return behind, [insult, threat, denial, report, target, weights(read)]


def grammar() -> tuple[Transducer, Transducer]:
    """The machine from the end, and all others as one from the start."""
    behind, forward = machines()
    whole = forward[0]
    for machine in forward[1:]:
        whole = compose(whole, machine)
    return behind, whole


class Scorer:
    """Scores of texts: the matched clauses' weights, summed and the largest."""

    def __init__(self, lexicon: dict[str, float]):
        self.behind, self.machine = grammar()
        self.stems = {k[:-1]: w for k, w in lexicon.items() if k.endswith("*")}
        self.lengths = sorted({len(s) for s in self.stems})
        self.words = {k: w for k, w in lexicon.items() if not k.endswith("*")}
        self.fixed: dict[str, tuple[str, float]] = {}
        classes = (
            (INTENSIFIERS, INTENSIFIER), (INTENTS, INTENT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT),
        )
        for words, label in classes:
            self.fixed |= {w: (label, 0.0) for w in words.split()}
        self.known: dict[str, tuple[str, float] | None] = {}

    def classify(self, word: str) -> tuple[str, float] | None:
        """Label and weight; None for other words and for marks."""
        weight = self.words.get(word, 0.0)
        for n in self.lengths:
            weight = max(weight, self.stems.get(word[:n], 0.0)) if len(word) >= n else weight
        if weight > 0:
            return (HARM if word in _HARMS else INSULT), weight
        return self.fixed.get(word)

    def clauses(self, text: str | None) -> list[float]:
        """Weights of the clauses that match, in order."""
        words = TOKENS.findall((text or "").lower())
        found = list(map(self.known.get, words, repeat(0)))
        if 0 in found:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            for k, word in enumerate(words):
                if found[k] == 0:
                    if word not in self.known:
                        self.known[word] = self.classify(word)
                    found[k] = self.known[word]
        hits = [k for k, x in enumerate(found) if x and x[1] > 0]
        out, done = [], -1
        for hit in hits:
            if hit <= done:
                continue
            begin = end = hit
            while begin > 0 and words[begin - 1].isalpha():
                begin -= 1
            while end + 1 < len(words) and words[end + 1].isalpha():
                end += 1
            done = end
            out.append(self.clause([x or _OTHER for x in found[begin : end + 1]]))
        return out

    def clause(self, words: list[tuple[str, float]]) -> float:
        """Weight of a clause of labelled words: targets from its end first, then all else from its start."""
        labels, state = [], self.behind.start
        for label, _ in reversed(words):
            state, label, _ = self.behind.step(state, label)
            labels.append(label)
        score, state = 0.0, self.machine.start
        for label, (_, weight) in zip(reversed(labels), words, strict=True):
            state, _, share = self.machine.step(state, label)
            score += weight * share
        return score

    def features(self, text: str | None) -> tuple[float, float]:
        clauses = self.clauses(text)
        return math.log1p(sum(clauses)), max(clauses, default=0.0)


_OTHER = (OTHER, 0.0)
_HARMS = frozenset(HARMS.split())


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    bias: float
    total: float
    largest: float

    def score(self, total: float, largest: float) -> float:
        z = self.bias + self.total * total + self.largest * largest
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def _forms(word: str) -> list[str]:
    """The word, and its beginnings of 4 to 6 letters."""
    return [word, *(word[:n] + "*" for n in (4, 5, 6) if len(word) > n)] if len(word) > 2 else []


def learn_lexicon(labelled: DataFrame, least: int, purity: float, size: int) -> dict[str, float]:
    """Words and word beginnings that stand in toxic texts far more often than in others.

    Kept are those in at least `least` texts, of which at least a share `purity` is toxic, that
    follow at least `least` different words: what only copies of one text share has one neighbour.
    `size` is the largest number of entries. The weight is the smoothed log odds over those of all
    texts.
    """

    def counted(every: Counter, toxic: Counter) -> pd.DataFrame:
        words = pd.Series(list(every), dtype=object)
        return pd.DataFrame({"word": words, "n": list(every.values()), "t": [toxic[w] for w in every]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every, toxic = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                found = {f for w in set(TOKENS.findall(text.lower())) for f in _forms(w)}
                every.update(found)
                if label:
                    toxic.update(found)
            if len(every) > 500_000:
                yield counted(every, toxic)
                every, toxic = Counter(), Counter()
        yield counted(every, toxic)

    counts = (
        labelled.select("text", "toxic").mapInPandas(run, "word string, n long, t long")
        .groupBy("word").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
        .filter((F.col("n") >= least) & (F.col("t") >= F.col("n") * purity))
    )
    often = {r["word"]: r for r in counts.orderBy(F.desc("t"), "word").limit(size).collect()}
    whole = labelled.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    prior = math.log((whole["t"] + 0.5) / (whole["n"] - whole["t"] + 0.5))
    candidates = frozenset(often)

    def neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = set()
            for text in batch["text"]:
                words = TOKENS.findall(text.lower())
                found.update(
                    (f, before) for before, w in zip(words, words[1:], strict=False) for f in _forms(w) if f in candidates
                )
            yield pd.DataFrame(list(found), columns=["word", "before"], dtype=object)

    varied = (
        labelled.filter("toxic = 1").select("text").mapInPandas(neighbours, "word string, before string").distinct()
        .groupBy("word").count().filter(F.col("count") >= least).collect()
    )
    kept = [often[r["word"]] for r in varied]
    odds = lambda r: math.log((r["t"] + 0.5) / (r["n"] - r["t"] + 0.5)) - prior
    return {r["word"]: min(6.0, max(0.5, odds(r))) for r in kept}


def fit(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic",
    most_labelled: int = 30_000, least: int = 8, purity: float = 0.7, size: int = 20_000,
) -> Model:
    """Lexicon and weights from labelled rows.

    The labelled rows are a bounded sample of about `most_labelled`, by a hash of the id. Rows with a
    NULL text or label teach nothing; an id with several labels teaches each. Listed insults and words
    of harm are always part of the lexicon, with weight 1 or what the labels give.
    """
    teach = frames.pick(labels, doc_id=id_col, toxic=toxic_col).filter("doc_id is not null and toxic is not null")
    n = teach.count()
    if n > most_labelled:
        ticket = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000))
        teach = teach.filter(ticket < F.lit(1_000_000.0 * most_labelled / n))
    docs = frames.pick(df, doc_id=id_col, text=text_col).filter("text is not null")
    rows = frames.stored(
        # Bounded by `most_labelled`.
        docs.join(F.broadcast(teach), "doc_id").select("text", F.col("toxic").cast("int")), "toxic-sample"
    )
    listed = dict.fromkeys([*INSULTS.split(), *HARMS.split()], 1.0)
    lexicon = listed | learn_lexicon(rows, least, purity, size)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(lexicon)
        for batch in batches:
            pairs = [scorer.features(t) for t in batch["text"]]
            yield pd.DataFrame({"total": [a for a, _ in pairs], "largest": [b for _, b in pairs], "toxic": batch["toxic"]})

    found = rows.mapInPandas(run, "total double, largest double, toxic int").toPandas()
    return Model(lexicon, *_logistic(found[["total", "largest"]].to_numpy(), found["toxic"].to_numpy()))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Bias and two weights, none of these negative, by Newton steps with a small ridge."""
    design = np.column_stack([np.ones(len(x)), x]).astype(float)
    w = np.array([-2.0, 2.0, 0.0])
    ridge = np.diag([0.01, 0.1, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + ridge
        step = np.linalg.solve(hessian, design.T @ (y - p) - ridge @ (w - [-2.0, 2.0, 0.0]))
        w = w + np.clip(step, -2, 2)
        w[1:] = np.maximum(w[1:], 0)
    return tuple(w.tolist())


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), predicted (score >= 0.5) and n_clauses of every row.

    Clauses end at marks and line ends. NULL, empty and wordless texts match no clause and get the
    score of such texts; NULL ids and repeated rows are kept; other columns are not read.
    """
    rows = frames.pick(df, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model.lexicon)
        for batch in batches:
            found = [scorer.clauses(t) for t in batch["text"]]
            scores = [model.score(math.log1p(sum(c)), max(c, default=0.0)) for c in found]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "score": scores, "predicted": [int(s >= 0.5) for s in scores],
                "n_clauses": [len(c) for c in found],
            })

    return rows.mapInPandas(run, f"doc_id {kind}, score double, predicted int, n_clauses int")


def clean(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `df` that are not predicted toxic, all columns as they are."""

    @F.pandas_udf("boolean")
    def passes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model.lexicon)
        for batch in batches:
            yield pd.Series([model.score(*scorer.features(t)) < 0.5 for t in batch], dtype=bool)

    return df.filter(passes(F.col(text_col)))
