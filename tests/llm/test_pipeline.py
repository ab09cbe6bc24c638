"""The pipeline's stages against brute force, each on its own input."""

import pandas as pd
import pytest
from conftest import SF_SMALL

import corpus_pipeline as C
from txnscope.llm import toxicity
from txnscope.llm.byte_bpe import ByteBpe
from txnscope.llm.words import text_bytes

from .test_operators import expected_kept, plain_fingerprint


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before and after each stage."""
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    for _, stage in C.STAGES:
        before = docs.toPandas().sort_values("doc_id")
        made = stage(spark, docs, SF_SMALL)
        after = made.toPandas()
        out.append((before, after))
        docs = spark.createDataFrame(after, made.schema)
    return out


def rows(frame):
    return sorted(map(tuple, frame.fillna("").itertuples(index=False)))


def test_names_and_columns(stages):
    assert [n for n, _ in C.STAGES] == ["toxicity", "simhash_near_dedup", "substring_dedup", "benchmark_decontamination", "best_fit_packing"]
    for before, after in stages[:-1]:
        assert list(before.columns) == list(after.columns) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_toxicity_stage(spark, stages):
    before, after = stages[0]
    model = toxicity.trained(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    score, _ = toxicity.score_slice(model, *text_bytes(before.text.fillna("").tolist()))
    assert rows(after) == rows(before[score < 0.5])


def test_simhash_stage(stages):
    before, after = stages[1]
    ids, fps = before.doc_id.tolist(), [plain_fingerprint(t) for t in before.text.fillna("")]
    label = list(ids)
    while True:
        new = [min(l for f2, l in zip(fps, label) if bin(f ^ f2).count("1") <= 4) for f in fps]
        if new == label:
            break
        label = new
    assert rows(after) == rows(before[[i == l for i, l in zip(ids, label)]])


def test_substring_stage(stages):
    before, after = stages[2]
    want = {i: kept for i, _, _, kept in expected_kept(list(zip(before.doc_id.tolist(), before.text.tolist())))}
    assert dict(zip(after.doc_id.tolist(), after.text.tolist())) == want
    assert rows(after.drop(columns="text")) == rows(before.drop(columns="text"))


def test_decontamination_stage(stages):
    before, after = stages[3]
    items = pd.read_parquet(f"{SF_SMALL}/benchmark.parquet").text.dropna().map(lambda t: " ".join(t.split())).tolist()
    clean = [not any(i in " ".join(t.split()) for i in items) for t in before.text.fillna("")]
    assert rows(after) == rows(before[clean])


def test_packing_stage(stages, vocabulary):
    before, after = stages[4]
    encoder = ByteBpe(vocabulary("byte_bpe_50k.json"))
    for doc_id, text in zip(before.doc_id, before.text.fillna("")):
        assert after[after.doc_id == doc_id].length.sum() == len(encoder.encode([text])[0]) + 1
    placed = after.sort_values(["sequence_id", "offset"])
    assert (placed.groupby("sequence_id").length.cumsum() - placed.length == placed.offset).all()
    assert placed.groupby("sequence_id").length.sum().max() <= 2048


def test_run(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    made = C.run(spark, SF_SMALL).select(*columns).toPandas()
    assert rows(made) == rows(stages[-1][1][columns])


def _key(row):
    return tuple(str(v) for v in row)


@pytest.mark.parametrize("name, stage", C.STAGES[:-1])
def test_stages_take_odd_rows(spark, odd, nothing, name, stage):
    """Nulls, empty texts, repeated rows and clashing names: the columns stay, and rows go only where the stage says so."""
    before, made = odd.collect(), stage(spark, odd, SF_SMALL)
    after = made.collect()
    assert made.columns == odd.columns
    if name == "substring_dedup":  # texts are rewritten, no row goes, the other columns stay
        at = odd.columns.index("text")
        assert sorted(_key(r[:at] + r[at + 1:]) for r in after) == sorted(_key(r[:at] + r[at + 1:]) for r in before)
        assert all(r["text"] == "" for r in after if r["doc_id"] in (1, 2, 3))
    elif name == "benchmark_decontamination":  # none of these holds an item
        assert sorted(map(_key, after)) == sorted(map(_key, before))
    else:
        left = sorted(map(_key, before))
        for r in map(_key, after):
            left.remove(r)  # every row that is kept is one of the input's, as often at most
    if name == "simhash_near_dedup":  # one row of each text without near copies here, and one of the texts without words
        assert {r["doc_id"] for r in after} >= {4, 7, 9, 10} and len([r for r in after if r["text"] == "same text under one id"]) == 1
        assert len([r for r in after if not (r["text"] or "").strip()]) == 1
    empty = stage(spark, nothing, SF_SMALL)
    assert empty.columns == odd.columns and empty.count() == 0


def test_packing_stage_takes_odd_rows(spark, odd, nothing):
    stage = C.STAGES[-1][1]
    out = stage(spark, odd, SF_SMALL).toPandas()
    assert out.length.between(1, 2048).all() and out.groupby("sequence_id").length.sum().max() <= 2048
    assert len(out[(out.piece == 0)]) == odd.count()  # a document has a first piece, be it empty, null or repeated
    assert stage(spark, nothing, SF_SMALL).count() == 0
