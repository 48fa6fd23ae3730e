"""Versioned changes of a stored table: once each, touching their partitions only."""

import os

import pytest
from pyspark.sql import functions as F

from outledger.operators import changes
from outledger.operators.ledger import StoredChange, apply_stored, create_stored, ledger, read_stored

SCHEMA = "id long, name string, seg string"


def files(root):
    """Every data file of the table with its time of change."""
    found = {}
    for folder, _, names in os.walk(f"{root}/t"):
        for n in names:
            if n.startswith("part-"):
                path = os.path.join(folder, n)
                found[os.path.relpath(path, f"{root}/t")] = os.stat(path).st_mtime_ns
    return found


@pytest.fixture
def root(spark, tmp_path):
    rows = [(k, f"n{k}", [None, "a", "b", "c/d", "e"][k % 5]) for k in range(40)]
    create_stored(spark.createDataFrame(rows, SCHEMA), str(tmp_path), "t", ["seg"])
    return str(tmp_path)


def steps(spark, text="delete from t where seg = 'e'"):
    new = spark.createDataFrame([(100, "x", "new"), (101, "y", "a")], SCHEMA)
    hit = F.col("id") == 2
    return [
        StoredChange("V4__drop", "t", lambda d: changes.delete_rows(d, F.col("seg") == "e"), F.col("seg") == "e", text),
        StoredChange("V2__add", "t", lambda d: changes.insert_rows(d, new), text="insert 2"),
        StoredChange("V3__move", "t", lambda d: changes.update_rows(d, hit, {"seg": F.lit("c/d")}), hit, "update 1"),
    ]


def run(spark, root, changes_, **more):
    return apply_stored(spark, root, {"t": SCHEMA}, {"t": ["seg"]}, changes_, **more)


def rows(spark, root):
    return sorted(map(repr, (tuple(r) for r in read_stored(spark, root, "t", SCHEMA).collect())))


def expected():
    segs = {k: [None, "a", "b", "c/d", "e"][k % 5] for k in range(40)}
    out = {k: (k, f"n{k}", s) for k, s in segs.items() if s != "e"}
    out |= {100: (100, "x", "new"), 101: (101, "y", "a"), 2: (2, "n2", "c/d")}
    return sorted(map(repr, out.values()))


def test_changes_are_applied_once(spark, root):
    before = files(root)
    assert run(spark, root, steps(spark)) == ["V2__add", "V3__move", "V4__drop"]
    assert rows(spark, root) == expected()
    after = files(root)
    untouched = {k: v for k, v in before.items() if k.startswith("seg=__HIVE")}
    assert untouched and all(after.get(k) == v for k, v in untouched.items())
    assert not any(k.startswith("seg=e") for k in after) and not os.path.exists(f"{root}/t/seg=e")
    assert run(spark, root, steps(spark)) == []
    assert files(root) == after
    entries = {r.name: r.partitions for r in ledger(spark, root).collect()}
    assert entries == {"V2__add": 2, "V3__move": 2, "V4__drop": 1}
    with pytest.raises(ValueError, match="V4__drop was applied with another text"):
        run(spark, root, steps(spark, "delete more"))
    with pytest.raises(ValueError, match="given twice"):
        run(spark, root, steps(spark) * 2)


def test_a_broken_run_is_taken_up(spark, root):
    """Stopped once the content is staged: the next run swaps it in and doesn't apply the change again."""
    calls = []

    def stop(name):
        if name == "V3__move" and not calls:
            calls.append(name)
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        run(spark, root, steps(spark), before_swap=stop)
    assert [r.name for r in ledger(spark, root).collect()] == ["V2__add"]
    broken = steps(spark)[:2] + [StoredChange("V3__move", "t", lambda d: 1 / 0, F.col("id") == 2, "update 1")]
    assert run(spark, root, broken) == ["V3__move", "V4__drop"]
    assert rows(spark, root) == expected()


def test_nothing_touched(spark, root):
    before = files(root)
    none = StoredChange("V9__none", "t", lambda d: changes.delete_rows(d, F.col("id") == -1), F.col("id") == -1, "x")
    assert run(spark, root, [none]) == ["V9__none"]
    assert files(root) == before
