"""Keys and signatures lie by document: they don't move again when a document's group is added."""

import pytest
from pyspark.sql import functions as F

from outledger.llm import frames, near_duplicates


@pytest.mark.parametrize("join", ["keys", "signature"])
def test_groups_come_to_the_heads(llm, monkeypatch, join):
    # Else frames as small as these are sent to all tasks.
    before = llm.conf.get("spark.sql.autoBroadcastJoinThreshold")
    llm.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans = {}
    real = frames.stored

    def stored(df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(frames, "stored", stored)
    texts = [" ".join(f"w{(n * 7 + k * (n % 3 + 1)) % 97}" for k in range(60)) for n in range(40)]
    rows = [(n, t) for n, t in enumerate(texts)] + [(100 + n, t) for n, t in enumerate(texts[:9])] + [(None, texts[0]), (200, None)]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    try:
        got = near_duplicates.near_duplicates(docs).collect()
    finally:
        llm.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == len(rows)
    found = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert all(found[100 + n] == found[n] for n in range(9)) and found[200] == 200
    plan = plans["prefix-rows"][0] if join == "keys" else plans["forest"][1]
    joined = plan[plan.index("SortMergeJoin"):]
    # Of the join's two sides the groups are dealt by document; the heads are read where they lie.
    assert joined.count("Exchange hashpartitioning(doc_id") == 1, joined
