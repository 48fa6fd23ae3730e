"""Quality, periodic runs and hard negatives against plain versions, with awkward rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from outledger.llm import hard_negatives, membership, quality, queries, runs

SCHEMA = "doc_id long, text string, score double, predicted int, n_runs long, fold int"


def docs(spark, pairs):
    """Documents with extra columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, 0.5, 7, 9, 1) for i, t in pairs], SCHEMA)


AWKWARD = [(1, None), (2, ""), (None, "a b c d e f"), (3, "same text twice"), (3, "same text twice"), (4, "w " * 5000)]


# ---------------------------------------------------------------- quality


def prose(rng, n):
    return " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(n)).capitalize() + "."


def graded(n, seed=1):
    rng, rows = random.Random(seed), []
    for k in range(n):
        text, label = prose(rng, rng.randint(5, 80)), 1
        if k % 4 == 0:
            label = 0
            text = text.upper().replace(" ", "!! ") if k % 8 else " ".join(w for w in text.split() for _ in range(rng.randint(3, 9)))
        rows.append((k, text, label))
    return rows


def test_quality(llm):
    rows = graded(600)
    df = docs(llm, [r[:2] for r in rows] + AWKWARD[:3])
    lab = llm.createDataFrame([(k, y) for k, _, y in rows] + [(None, 1), (3, None), (5, 7)], "doc_id long, quality int")
    model = quality.fit(df.filter("doc_id % 3 <> 0"), lab.filter("doc_id % 3 <> 0"))
    found = quality.score(df, model).collect()
    got = {r.doc_id: r for r in found if r.doc_id is not None}
    held = [(k, y) for k, _, y in rows if k % 3 == 0 and k > 2]
    assert np.mean([got[k].predicted == y for k, y in held]) > 0.97
    assert len(found) == 603 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    nothing = quality.statistics("")
    empty = {r.doc_id: r.score for r in quality.score(docs(llm, [(1, None), (2, "")]), model).collect()}
    assert empty[1] == empty[2] == model.scores(nothing[None])[0]


def test_quality_is_the_plain_discriminant(llm):
    """Fitted from sums per task, scored by cached factors: as means, covariances and determinants by numpy."""
    rows = graded(300, 2)
    df, lab = docs(llm, [r[:2] for r in rows]), llm.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, quality int")
    model = quality.fit(df.repartition(7), lab, alphas=(0.3,), gammas=(0.2,))
    x, y = np.stack([quality.statistics(t) for _, t, _ in rows]), np.array([r[2] for r in rows])
    z = (x - x.mean(axis=0)) / np.sqrt(np.maximum(x.var(axis=0), 1e-6))
    own = [np.cov(z[y == k], rowvar=False, bias=True) for k in (0, 1)]
    pooled = sum(c * np.mean(y == k) for k, c in enumerate(own))
    logs = []
    for k in (0, 1):
        c = 0.7 * own[k] + 0.3 * pooled
        c = 0.8 * c + 0.2 * np.diag(np.diag(c)) + 1e-4 * np.eye(len(c))
        off = z - z[y == k].mean(axis=0)
        far = np.einsum("ij,jk,ik->i", off, np.linalg.inv(c), off)
        logs.append(np.log(np.mean(y == k)) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * far)
    assert model.differences(x) == pytest.approx(logs[1] - logs[0], rel=1e-6, abs=1e-6)
    again = quality.fit(df.repartition(3), lab, alphas=(0.3,), gammas=(0.2,))
    assert again.slope == model.slope and again.bias == model.bias and (again.whiten == model.whiten).all()


def test_quality_of_little(llm):
    df = docs(llm, [(k, t) for k, t, _ in graded(8)] + AWKWARD)
    ones = llm.createDataFrame([(k, 1) for k in range(8)], "doc_id long, quality int")
    for labels in (ones, ones.limit(0)):
        model = quality.fit(df, labels)
        assert model is None
        assert {r.score for r in quality.score(df, model).collect()} == {0.5}
    both = llm.createDataFrame([(2, 1), (4, 0)], "doc_id long, quality int")
    assert quality.score(df, quality.fit(df, both)).count() == 14
    assert quality.score(df.limit(0), None).count() == 0


def test_quality_query(llm, tmp_path):
    """Labels of held-out rows are never looked at, and held-out rows are graded well."""
    rows = graded(400, 3)
    docs(llm, [r[:2] for r in rows] + [(900, None), (901, "")]).write.parquet(str(tmp_path / "documents.parquet"))
    fold = {k: zlib.crc32(str(k).encode()) % 4 for k, _, _ in rows}
    wrong = [(k, 1 - y if fold[k] == 2 else y) for k, _, y in rows]
    llm.createDataFrame(wrong, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.doc_id: r for r in queries.op11_quality(llm, str(tmp_path)).collect()}
    assert len(got) == 402 and all(got[k].held_out == (f == 2) for k, f in fold.items())
    assert np.mean([got[k].predicted == y for k, _, y in rows if fold[k] == 2]) > 0.95


# ---------------------------------------------------------------- runs


def plain_runs(words, least=12):
    """Every period: stretches of words that equal the word a period later."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            begin = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - begin + q >= max(least, 2 * q):
                out.setdefault((begin, i + q), q)
            i += i == begin
    return sorted((b, e - b, q) for (b, e), q in out.items())


def repetitive(rng):
    letters, n = rng.choice([1, 2, 2, 3, 5, 50]), rng.choice([0, 1, 2, 5, 12, 13, 40, 120])
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if words else 0):
        at = rng.randrange(len(words))
        width = rng.randint(1, min(9, len(words) - at))
        words[at:at] = words[at : at + width] * rng.randint(2, 8)
    return [f"w{w}" for w in words]


def fibonacci(n):
    a, b = ["x"], ["x", "y"]
    while len(b) < n:
        a, b = b, b + a
    return b


def by_grammar(documents):
    words, starts = runs.word_numbers(documents)
    begin, length, period = runs.runs(words, starts)
    owner = np.searchsorted(starts, begin, side="right") - 1
    return [
        sorted(zip((begin[owner == k] - starts[k]).tolist(), length[owner == k].tolist(), period[owner == k].tolist(), strict=True))
        for k in range(len(documents))
    ]


def test_runs_against_brute_force():
    rng = random.Random(1)
    for _ in range(40):
        documents = [repetitive(rng) for _ in range(15)]
        assert by_grammar(documents) == [plain_runs(d) for d in documents]
    thue = [str(bin(i).count("1") & 1) for i in range(600)]
    special = [fibonacci(800), thue, ["a"] * 900, [str(k) for k in range(70)] * 9, [], ["a", "b"] * 300]
    assert by_grammar(special) == [plain_runs(d) for d in special]


def test_runs_do_not_cross_documents():
    assert by_grammar([["a"] * 11, ["a"] * 11, ["a"] * 12]) == [[], [], [(0, 12, 1)]]
    # Documents that are finished early between others that share their words.
    documents = [list("xyzxyz"), list("xyzw"), list("xyzxyzxyz"), list("zxyz"), list("xyzxyzxyzxyz"), list("xyz")]
    words, starts = runs.word_numbers(documents)
    grammar = runs.Grammar(words, starts)
    owner = np.searchsorted(starts, grammar.place, side="right")
    assert (grammar.place + grammar.size[grammar.rule] <= starts[owner]).all()
    assert by_grammar(documents) == [plain_runs(d) for d in documents]


def test_grammar_derives_its_text():
    rng = random.Random(4)
    documents = [repetitive(rng) for _ in range(30)] + [["a"] * 500]
    words, starts = runs.word_numbers(documents)
    grammar = runs.Grammar(words, starts)
    # All places of a rule read the same, and the rules of a text of one word are few.
    seen = {}
    for rule, place in zip(grammar.rule.tolist(), grammar.place.tolist(), strict=True):
        text = words[place : place + grammar.size[rule]].tolist()
        assert seen.setdefault(rule, text) == text
    assert len(grammar.rule) == sum(max(0, len(d) - 1) for d in documents)
    alone = runs.Grammar(*runs.word_numbers([["a"] * 4096]))
    assert alone.rules < 30


def expected_row(doc_id, words):
    found = plain_runs(words)
    kept = [w for k, w in enumerate(words) if not any(b + q <= k < b + n for b, n, q in found)]
    top = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    b, n, q = top or (None, None, None)
    listed = "".join(f"{b},{n},{q}\n" for b, n, q in found)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, " ".join(kept))]
    return (doc_id, len(found), b, n, q, top and 1000 * n // q, *digests)


def test_periodic_runs(llm):
    rng = random.Random(5)
    rows = [(k, " ".join(repetitive(rng))) for k in range(60)] + AWKWARD[:5] + [(8, "k " * 300), (9, "é f\t" * 20)]
    got = runs.periodic_runs(docs(llm, rows)).collect()
    expected = [expected_row(k, [w for w in (t or "").replace("\t", " ").split(" ") if w]) for k, t in rows]
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(repr(tuple(r[n] for n in names)) for r in got) == sorted(map(repr, expected))
    for r in got:
        assert hashlib.sha256(r.collapsed.encode()).hexdigest() == r.collapsed_sha256 and len(r.runs) == r.n_runs
    assert runs.periodic_runs(docs(llm, rows).limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(docs(llm, rows), least=8)


def test_runs_query(llm, tmp_path):
    rng = random.Random(6)
    rows = [(k, " ".join(f"v{rng.randint(0, 400)}" for _ in range(rng.randint(0, 90)))) for k in range(150)] + [(900, None), (901, "")]
    docs(llm, rows).write.parquet(str(tmp_path / "documents.parquet"))
    expected, changed = [], 0
    for k, t in rows:
        w = (t or "").split()
        n, h = len(w), zlib.crc32(str(k).encode())
        if h % 10 == 0 and n:
            g, old = h // 10, list(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [old[a + (i - a) % p] if i >= a else old[i] for i in range(n)]
            changed += 1
        expected.append(expected_row(k, w))
    got = queries.op12_runs(llm, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(expected) and changed > 5


# ---------------------------------------------------------------- hard negatives


def plain_negatives(data, anchors, k=5, positives=5):
    """data: (id, label, whole-number vector); every pair scored one by one."""
    out = []
    for a_id, a_label, a in anchors:
        scored = [(-sum(map(int.__mul__, a, v)), i, label) for i, label, v in data if len(v) == len(a)]
        own = sorted(s[:2] for s in scored if s[2] == a_label and s[1] != a_id)[:positives]
        for p, p_id in own:
            found = sorted(s[:2] for s in scored if s[2] != a_label and -80 * p <= -100 * s[0] <= -100 * p)[:k]
            out += [(a_id, p_id, n, i, -p, -s) for n, (s, i) in enumerate(found, 1)]
    return sorted(out)


def whole(vector):
    return [int(np.floor(256 * x)) for x in vector]


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, label int, embedding array<double>, rank int, score int")


def test_hard_negatives(llm, monkeypatch):
    rng = np.random.default_rng(4)
    found = np.round(np.abs(rng.normal(size=(500, 12))) * 0.3, 2)
    found[50:120] = found[0]  # ties
    labels = rng.integers(0, 6, 500)
    labels[rng.random(500) < 0.4] = 0  # a label with more than a third of the rows
    good = [(k, int(label), v.tolist()) for k, (label, v) in enumerate(zip(labels, found, strict=True))]
    good += [(100, 1, [0.2] * 12), (100, 1, [0.2] * 12), (600, 3, [0.5] * 3), (601, 4, [0.5] * 3), (602, 3, [0.5, 0.5, 0.6]), (700, 5, [])]
    bad = [(1000, 1, None), (1100, 1, [1.0, None]), (1200, 2, [float("nan")] * 12), (None, 1, [0.1] * 12),
           (1300, None, [0.5] * 12), (1400, 1, [float("inf")] * 12)]
    df = vectors(llm, good + bad)
    data = [(i, label, whole(v)) for i, label, v in good]
    asked = list(dict.fromkeys((i, label, tuple(v)) for i, label, v in data if i % 100 == 0))
    expected = plain_negatives(data, asked)
    assert len(expected) > 60
    for rows, anchors in ((1 << 13, 1 << 9), (37, 2)):
        monkeypatch.setattr(hard_negatives, "ROWS", rows)
        monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
        got = hard_negatives.hard_negatives(df, df.filter("vec_id % 100 = 0")).collect()
        assert sorted(map(tuple, got)) == expected
    assert hard_negatives.hard_negatives(df.limit(0), df.limit(0)).count() == 0
    assert hard_negatives.hard_negatives(df, df.limit(0)).count() == 0


def test_large_components(llm):
    rng = random.Random(9)
    rows = [(k, k % 3, [rng.choice([1e6, 3e6, 5e6]) * rng.random() for _ in range(4)]) for k in range(120)]
    df = vectors(llm, rows)
    data = [(i, label, whole(v)) for i, label, v in rows]
    got = hard_negatives.hard_negatives(df, df.filter("vec_id % 10 = 0")).collect()
    assert sorted(map(tuple, got)) == plain_negatives(data, [d for d in data if d[0] % 10 == 0])
    with pytest.raises(OverflowError):
        hard_negatives.products(np.array([[2.0**40]]), np.array([[2.0**40]]))


# ---------------------------------------------------------------- membership


def test_membership(llm):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(500)]), f"t{k}") for k in range(2000)]
    ids = [None, *rng.sample(range(-50, 600), 200)]
    df = llm.createDataFrame(rows, "doc_id long, text string")
    gone = llm.createDataFrame([(i,) for i in ids], "doc_id long")
    wanted = sorted((r for r in rows if r[0] is None or r[0] not in ids), key=repr)
    # A bitmap that is nearly full changes nothing but what is moved.
    for bits in (membership.MOST_BITS, 1 << 6):
        assert sorted(map(tuple, membership.without(df, gone, "doc_id", bits).collect()), key=repr) == wanted
        kept = df.filter(membership.maybe_in(gone, "doc_id", bits)).collect()
        assert {r.doc_id for r in kept} >= {k for k, _ in rows if k in ids and k is not None}
        assert all(r.doc_id is not None for r in kept)
    assert membership.without(df, gone.limit(0), "doc_id").count() == 2000
    assert membership.without(df.limit(0), gone, "doc_id").count() == 0
