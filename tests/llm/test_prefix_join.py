"""The prefix join of near duplicates: few rows for a pair, and no link lost."""

import random

from pyspark.sql import functions as F

from outledger.llm import near_duplicates


def heads_of(spark, texts):
    """Documents, their profiles and one group for each: nothing is linked by the forest yet."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    heads = near_duplicates.profiles(docs, 5, 75, len(texts)).localCheckpoint()
    return docs, heads, heads.select("doc_id", F.col("doc_id").alias("component"))


def test_a_shared_passage_is_one_row_of_a_document(llm):
    rng = random.Random(5)
    word = lambda: f"w{rng.randint(0, 10**9)}"
    passage = [word() for _ in range(400)]
    texts = [" ".join([word() for _ in range(300)] + passage + [word() for _ in range(300)]) for _ in range(2)]
    _, heads, groups = heads_of(llm, texts)
    rows = near_duplicates.crossing(heads, groups)
    found = {r.doc_id: (r.rows, r.keys, r.shared) for r in rows.groupBy("doc_id").agg(
        F.count("*").alias("rows"), F.sum("times").alias("keys"), F.max("shared").alias("shared")).collect()}
    assert len(found) == 2 and all(n == 1 and keys == shared > 20 for n, keys, shared in found.values())
    assert near_duplicates.across_groups(rows, rows, 75, True).count() == 0


def test_the_prefix_join_alone_finds_every_link(llm):
    rng = random.Random(6)
    bases = [[f"v{rng.randint(0, 3000)}" for _ in range(rng.choice([7, 30, 90, 200]))] for _ in range(25)]
    texts = []
    for _ in range(220):
        words = list(rng.choice(bases))
        for _ in range(rng.randint(0, max(1, len(words) // 25))):
            words[rng.randrange(len(words))] = f"n{rng.randint(0, 10**6)}"
        if rng.random() < 0.3:
            words += rng.choice(bases)[: rng.randint(1, 40)]
        texts.append(" ".join(words))
    docs, heads, groups = heads_of(llm, texts)
    sets = [set(near_duplicates.shingles(t).tolist()) for t in texts]
    pairs = [(a, b) for b in range(len(sets)) for a in range(b) if 175 * len(sets[a] & sets[b]) >= 75 * (len(sets[a]) + len(sets[b]))]
    rows = near_duplicates.crossing(heads, groups)
    met = {tuple(r) for r in near_duplicates.across_groups(rows, rows, 75, True).collect()}
    assert len(pairs) > 100 and set(pairs) <= met
    lowest = list(range(len(sets)))
    for _ in sets:
        for a, b in pairs:
            lowest[a] = lowest[b] = min(lowest[a], lowest[b])
    done = near_duplicates.completed(groups, heads, docs, 5, 75)
    assert {r.doc_id: r.component for r in done.collect()} == dict(enumerate(lowest))
