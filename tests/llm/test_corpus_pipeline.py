"""The stages of the pipeline on rows with NULL, repeated and shared ids."""

import random
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from outledger.llm import decontamination, frames, mixing, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts(n, seed=1):
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(40)) for _ in range(n)]


def frame(llm, rows):
    return llm.createDataFrame([(k, t, "en", s, len(t or "")) for k, t, s in rows], SCHEMA)


def counted(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_near_duplicate_stage(llm, tmp_path):
    a, b, c, d, e = texts(5)
    rows = [(9, a), (4, a), (4, b), (4, b), (5, c), (5, d), (3, d), (None, e), (None, e), (7, None), (7, None)]
    df = frame(llm, [(*r, "s") for r in rows])
    got = corpus_pipeline.drop_near_duplicates(llm, df, str(tmp_path))
    assert counted(got) == Counter([(4, a), (4, b), (5, c), (3, d), (None, e), (None, e), (7, None), (7, None)])


def test_decontamination_stage(llm, tmp_path):
    a, b, c = texts(3, 2)
    llm.createDataFrame([(1, a)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, "so " + a), (1, b), (None, a), (None, c), (2, c), (2, c), (3, None)]
    got = corpus_pipeline.drop_contaminated(llm, frame(llm, [(*r, "s") for r in rows]), str(tmp_path))
    assert counted(got) == Counter([(1, b), (None, c), (2, c), (2, c), (3, None)])


def test_mixing_stage(llm, tmp_path):
    rng = random.Random(3)
    rows = [(k % 40, "w " * rng.randint(1, 60), rng.choice("abc")) for k in range(120)]
    rows += [(None, "x y " * k, "b") for k in range(1, 30)] + rows[:3]
    df = frame(llm, rows)
    got = counted(corpus_pipeline.mix_sources(llm, df, str(tmp_path)))
    expected = Counter()
    for r in mixing.mix(df.withColumn("body", df["text"]), carry=("body",)).collect():
        expected[r.doc_id, r.body] += r.copies
    assert got == +expected and any(k is None for k, _ in got)


@pytest.mark.parametrize("stage", ["drop_near_duplicates", "mix_sources"])
def test_empty_tables(llm, tmp_path, stage):
    df = frame(llm, [(1, "a", "s")]).limit(0)
    assert getattr(corpus_pipeline, stage)(llm, df, str(tmp_path)).count() == 0


# ---------------------------------------------------------------- the whole pipeline


def planted(llm, folder):
    """Documents with toxic texts, copies, edited copies, benchmark passages, NULL, empty and wordless texts."""
    rng = random.Random(8)
    clean = texts(60, 5)
    passage = " ".join(f"b{rng.randint(0, 10**6)}" for _ in range(14))
    rows = [(k, t, rng.choice(["s1", "s1", "s2", None])) for k, t in enumerate(clean)]
    for k in range(100, 160):
        words = clean[k % 10].split()
        words[rng.randrange(40)] = f"n{k}"
        rows.append((k, " ".join(words), "s1") if k % 3 else (k, clean[k % 10], "s2"))
    rows += [(k, f"before {passage} after {t}", "s3") for k, t in enumerate(texts(6, 9), 200)]
    toxic = []
    for k in range(300, 340):
        words = ["".join(rng.choices("abcdefghijklm", k=6)) for _ in range(40)]
        for _ in range(3):
            words.insert(rng.randrange(40), "grom" + rng.choice(["pel", "pax", "tul", "zim"]))
        toxic.append((k, " ".join(words), "s2"))
    rows += toxic + [(400, None, "s1"), (401, "", "s1"), (402, " \n ", None), (403, "ok", "s3")]
    labels = [(k, int(300 <= k < 340), 1) for k, _, _ in rows]
    frame(llm, rows).write.parquet(f"{folder}/documents.parquet")
    llm.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{folder}/labels.parquet")
    llm.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, passage


def firsts_of_groups(rows):
    """The smallest id of every group of texts with three quarters of their shingles in common."""
    sets = {}
    for k, t, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        n = min(5, len(w))
        sets[k] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if w else set()
    lowest, todo = {}, sorted(sets, reverse=True)
    while todo:
        first = todo.pop()
        reach = [first]
        while reach:
            a = reach.pop()
            lowest[a] = first
            near = [b for b in todo if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
            todo = [b for b in todo if b not in near]
            reach += near
    return {k for k, first in lowest.items() if k == first}


def test_whole_pipeline(llm, tmp_path):
    folder = str(tmp_path)
    rows, passage = planted(llm, folder)
    docs, labels = frames.table(llm, folder, "documents"), frames.table(llm, folder, "labels")
    scores = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert sum(scores[k] for k in range(300, 340)) > 30 and not any(scores[k] for k, _, _ in rows if not 300 <= k < 340)
    left = [r for r in rows if not scores[r[0]]]
    kept = firsts_of_groups(left)
    left = [r for r in left if r[0] in kept]
    assert not kept & set(range(100, 160))
    window = [" ".join(passage.split()[j : j + 10]) for j in range(5)]
    left = [r for r in left if not any(w in " ".join(decontamination.words(r[1])) for w in window)]
    assert not {r[0] for r in left} & set(range(200, 206))
    mixed = {r.doc_id: r.copies for r in mixing.mix(frame(llm, left)).collect()}
    library, expected, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), [], 0
    for k, t, _ in sorted(left):
        for _ in range(mixed[k]):
            ids = library.encode(t or "", add_special_tokens=False).ids + [2]
            expected.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    got = corpus_pipeline.run(llm, folder).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == expected
    assert any(n > 1 for n in mixed.values()) and len(expected) > 40


def test_toxicity_stage_on_odd_rows(llm, tmp_path):
    planted(llm, str(tmp_path))
    odd = [(1, None, "s"), (None, "", "s"), (None, "so gromtul and gromzim here gromtul", "s"), (3, "plain words", "s"), (3, "plain words", "s")]
    got = corpus_pipeline.drop_toxic(llm, frame(llm, odd), str(tmp_path))
    assert counted(got) == Counter([(1, None), (None, ""), (3, "plain words"), (3, "plain words")])
    assert corpus_pipeline.drop_toxic(llm, frame(llm, odd).limit(0), str(tmp_path)).count() == 0


def test_token_stage_on_odd_rows(llm, tmp_path):
    rows = [(None, "a b", "s"), (5, None, "s"), (5, "a b", "s"), (2, "", "s")]
    got = corpus_pipeline.write_token_file(llm, frame(llm, rows), str(tmp_path)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 2, 5, 5] and sorted(r.n_tokens for r in got[1:]) == [1, 1, got[0].n_tokens]
    assert corpus_pipeline.write_token_file(llm, frame(llm, rows).limit(0), str(tmp_path)).count() == 0
