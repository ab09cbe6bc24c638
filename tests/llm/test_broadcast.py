"""Tables that grow with the corpus are not broadcast by the size that Spark takes them to have before they run."""

import pytest

from txnscope.llm import decontaminate, simhash
from txnscope.plans.frames import materialize

from .test_operators import plain_fingerprint, smallest_labels


def plan_of(df):
    """The plan before it runs."""
    return df._jdf.queryExecution().executedPlan().toString()


def unmeasured(plan):
    """Broadcasts without a shuffle below, whose size is not known before they are made."""
    lines, out = plan.splitlines(), []
    for k, line in enumerate(lines):
        depth = line.find("BroadcastExchange")
        if depth >= 0:
            below = []
            for x in lines[k + 1:]:
                if len(x) - len(x.lstrip(" :+-*")) <= depth:
                    break
                below.append(x)
            out += [line] * (not any("Exchange hashpartitioning" in x for x in below))
    return out


@pytest.fixture
def plans(monkeypatch):
    """Plans of the tables that SimHash writes."""
    seen = {}

    def noted(df, name):
        seen[name] = plan_of(df)
        return materialize(df, name)

    monkeypatch.setattr(simhash, "materialize", noted)
    return seen


@pytest.fixture
def docs(spark, tmp_path):
    """(table from a file, so that its size is known; {id: text}): copies, near copies and texts of their own."""
    texts = {i: " ".join(f"w{i % 20}x{k}" for k in range(200)) + " end" * (i // 40) for i in range(60)}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    return spark.read.parquet(f"{tmp_path}/docs"), texts


def groups(texts):
    fps = [plain_fingerprint(texts[i]) for i in sorted(texts)]
    return smallest_labels(len(fps), [(a, b) for a in range(len(fps)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 4])


def test_simhash_stage_broadcasts_nothing_that_grows(docs, plans):
    df, texts = docs
    out = simhash.keep_one(df)
    plan = plan_of(out)
    assert sorted(r["doc_id"] for r in out.collect()) == [i for i, l in enumerate(groups(texts)) if i == l]
    assert "Generate explode" in plans["simhash-links"]  # rows by bucket
    assert not unmeasured(plan) and not [name for name, found in plans.items() if "Broadcast" in found]
    assert all("SortMergeJoin" in found for found in (plan, plans["simhash-links"], plans["simhash-labels"], plans["simhash-chosen"]))


def test_simhash_broadcasts_nothing_that_grows(docs, plans):
    df, texts = docs
    out = simhash.near_duplicates(df)
    assert not unmeasured(plan_of(out)) and plan_of(out).count("SortMergeJoin") >= 2
    assert {r["key"]: r["component_id"] for r in out.collect()} == dict(enumerate(groups(texts)))


def test_benchmark_words_are_not_broadcast(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, f"what is the {w} of {i}? it is {w}") for i, w in enumerate(["sum", "root", "sum", "end"])], "item_id long, text string").write.parquet(f"{tmp_path}/items")
    items, found = spark.read.parquet(f"{tmp_path}/items"), []
    whole = type(items).toLocalIterator
    monkeypatch.setattr(type(items), "toLocalIterator", lambda self, *a: found.append(plan_of(self)) or whole(self, *a))
    index, = decontaminate.indexes(items, "item_id", "text")
    assert sorted(index.ids) == [0, 1, 2, 3]
    assert len(found) == 1 and "Generate explode" in found[0] and not unmeasured(found[0]) and "SortMergeJoin" in found[0]
