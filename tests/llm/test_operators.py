"""Each operator against a plain rendering of its rule, and on the odd cases."""

import hashlib
import random
import re
import sys
import zlib

import numpy as np
import pytest
import xxhash

from conftest import SF_SMALL
from txnscope.llm import ans, decontaminate, licenses, minhash, packing, sharding, simhash, substring, token_counts, toxicity
from txnscope.llm.byte_bpe import ByteBpe
from txnscope.llm.components import connected
from txnscope.llm.fm_index import FMIndex, WaveletMatrix
from txnscope.llm.queries import QUERIES
from txnscope.llm.tables import NO_ID
from txnscope.llm.words import text_bytes

from .conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def odd_texts():
    rng = random.Random(7)
    alphabet = " \n\tab'sé1<|▁　\x1c.\x00Z"
    return [t or "" for _, t in ODD] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(500)]


# 1 substring dedup

def expected_kept(rows, window=20):
    """{(id, text): (words, removed, kept)}; equal starts under one id do not remove each other."""
    first, out = {}, []
    listed = sorted((NO_ID if i is None else i, t or "") for i, t in rows)
    for key, text in listed:
        words = WORD.findall(text)
        for s in range(len(words) - window + 1):
            w = tuple(words[s:s + window])
            first[w] = min(first.get(w, (key, s)), (key, s))
    for key, text in listed:
        words = WORD.findall(text)
        covered = [False] * len(words)
        for s in range(len(words) - window + 1):
            if first[tuple(words[s:s + window])] != (key, s):
                covered[s:s + window] = [True] * window
        out.append((None if key == NO_ID else key, len(words), sum(covered), " ".join(w for w, c in zip(words, covered) if not c)))
    return sorted(out, key=str)


def kept(df, **kw):
    rows = substring.remove_repeated(df, **kw).select("doc_id", "n_words", "n_removed", "text").collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_substring_matches_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(8)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 120))) for _ in range(12)]
    rows = [(i, " ".join(rng.choice(base).split()[:rng.randint(0, 90)]) + " " + rng.choice(base)) for i in range(60)]
    rows += [(100 + i, "a b " * 40) for i in range(3)] + [(200, "z " * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert kept(df) == expected_kept(rows)
    assert kept(df, window=5) == expected_kept(rows, 5)


def test_substring_hot_passage_is_spread(spark, monkeypatch):
    monkeypatch.setattr(substring, "HOT_PARTS", 2)
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(i, f"a{i} b{i} c{i} {passage} d{i} e{i}") for i in range(80)]
    assert kept(spark.createDataFrame(rows, "doc_id long, text string")) == expected_kept(rows)


def test_substring_odd_cases(odd, nothing):
    assert kept(odd) == expected_kept(ODD)
    assert substring.remove_repeated(nothing).count() == 0
    row = substring.remove_repeated(odd).where("doc_id = 6").first()
    assert (row["row"], row["n_words"], [tuple(s) for s in row["removed"]]) == ("r", 62, [(1, 61)])


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_substring_repeated_ids(spark, monkeypatch, parts):
    monkeypatch.setattr(substring, "pieces_for", lambda df, mb: parts)
    passage, other, third = (" ".join(f"{n}{i}" for i in range(40)) for n in "pqr")
    rows = [(1, passage), (1, passage), (2, passage), (None, other), (None, other), (3, f"a b c {other}"),
            (4, f"one two {third} end"), (4, f"een twee {third} eind"), (4, f"zz {third}"), (4, f"aa bb cc dd {third}"), (5, third),
            (6, " ".join(f"s{i % 25}" for i in range(80))), (6, " ".join(f"s{i % 25}" for i in range(80)))]
    assert kept(spark.createDataFrame(rows, "doc_id long, text string")) == expected_kept(rows)
    monkeypatch.setattr(substring, "HOT_PARTS", 1)
    assert kept(spark.createDataFrame(rows, "doc_id long, text string")) == expected_kept(rows)


def test_substring_real_texts(spark, sf_docs):
    rows = list(sf_docs.items())
    assert kept(spark.createDataFrame(rows, "doc_id long, text string")) == expected_kept(rows)


def test_backward_search_counts():
    rng = np.random.default_rng(5)
    text = np.append(rng.integers(1, 6, 400), 0)
    index = FMIndex(text, 6, 8)
    matrix = WaveletMatrix(text, 6)
    at = np.arange(402)
    for c in range(6):
        run = matrix.rank(np.full(402, c), at) - matrix.rank(np.array([c]), np.array([0]))
        assert run.tolist() == [int((text[:i] == c).sum()) for i in range(402)]
    words = text.tolist()
    last = np.arange(7, 400)
    matched, row = index.matching(text, last, 8)
    for e, m in zip(last.tolist(), matched.tolist()):
        best = 0
        for n in range(1, 9):
            if sum(words[i:i + n] == words[e - n + 1:e + 1] for i in range(len(words) - n + 1)) >= 2:
                best = n
        assert m == best
    groups = {}
    for e, r in zip(last.tolist(), row.tolist()):
        if r >= 0:
            assert groups.setdefault(r, words[e - 7:e + 1]) == words[e - 7:e + 1]


# 2 toxicity

def chain_marginals(emission, first, start, move):
    out = np.zeros(len(emission))
    for a, b in zip(first, first[1:]):
        n = b - a
        if not n:
            continue
        weight = np.stack([1 / (1 + np.exp(emission[a:b])), 1 / (1 + np.exp(-emission[a:b]))], axis=1)
        total, toxic = 0.0, np.zeros(n)
        for code in range(2 ** n):
            state = [(code >> k) & 1 for k in range(n)]
            p = start[state[0]] * weight[0, state[0]]
            for k in range(1, n):
                p *= move[state[k - 1], state[k]] * weight[k, state[k]]
            total += p
            toxic += p * np.array(state)
        out[a:b] = toxic / total
    return out


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(1)
    first = np.array([0, 3, 3, 10, 11, 19])
    emission, start, move = rng.normal(0, 2, 19), np.array([0.9, 0.1]), np.array([[0.8, 0.2], [0.4, 0.6]])
    assert np.allclose(toxicity.marginals(emission, first, start, move), chain_marginals(emission, first, start, move))


@pytest.fixture(scope="module")
def toxic_texts():
    rng = random.Random(2)
    plain = ["".join(rng.choice("aeioustnr") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    texts, labels = [], []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 80))]
        label = i % 4 == 0
        for _ in range(rng.randint(1, 3) if label else 0):
            words.insert(rng.randint(0, len(words)), rng.choice(["zorgish", "blarg,", "Kwexing", "kwexed"]))
        texts.append(" ".join(words))
        labels.append(label)
    return texts, np.array(labels)


def test_toxicity_held_out(toxic_texts):
    texts, labels = toxic_texts
    model = toxicity.fit(texts[:400], labels[:400], 1.0)
    score, spans = toxicity.score_slice(model, *text_bytes(texts[400:]))
    assert ((score >= 0.5) == labels[400:]).mean() > 0.98
    found = {texts[400 + i][s["start"]:s["end"]].strip(",").lower() for i in np.flatnonzero(labels[400:]) for s in spans[i]}
    assert found & {"zorgish", "blarg", "kwexing", "kwexed"}


def test_toxicity_odd_cases(spark, odd, nothing, toxic_texts):
    model = toxicity.fit(*toxic_texts)
    rows = toxicity.score_toxicity(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    empty = {r["score"] for r in rows if not (r["text"] or "").strip()}
    assert len(empty) == 1 and next(iter(empty)) < 0.5
    assert toxicity.score_toxicity(nothing, model).count() == 0
    alone = toxicity.fit([], np.zeros(0))
    assert toxicity.score_toxicity(odd, alone).where("score != 0.5").count() == 0


def test_toxicity_training_labels(spark, toxic_texts, monkeypatch):
    texts, labels = toxic_texts
    docs = spark.createDataFrame([*enumerate(texts), (None, "zorgish"), (700, None)], "doc_id long, text string")
    marks = [(i, int(t)) for i, t in enumerate(labels)]
    extra = [(0, 0), (0, 1), (1, None), (None, 1), (700, 0), (9999, 1)]  # both ways, without label, id, text or document
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic, weight: seen.append(sorted(zip(texts, toxic.tolist()))))
    for rows in (marks, marks + extra, extra + marks[::-1]):
        toxicity.trained(docs, spark.createDataFrame(rows, "doc_id long, toxic long"))
    kept = {texts[i]: bool(t) for i, t in enumerate(labels) if zlib.crc32(str(i).encode()) % 5}
    assert dict(seen[0]) == kept and seen[1] == seen[2]
    assert dict(seen[1]) == kept | ({texts[0]: True} if zlib.crc32(b"0") % 5 else {})


def test_toxicity_spans_are_code_points(toxic_texts):
    model = toxicity.fit(*toxic_texts)
    text = "ñandú 日本語 zorgish ok"
    _, spans = toxicity.score_slice(model, *text_bytes(["sun", text]))
    assert [text[s["start"]:s["end"]] for s in spans[1]] == ["zorgish"]


# 3 token counts

def test_token_counts_match_library(vocabulary):
    import sentencepiece

    path = vocabulary("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), token_counts.PieceCounts(path)
    for text in odd_texts():
        assert own.of(text) == len(library.encode(text)), repr(text)


def test_token_counts_odd_cases(odd, nothing, vocabulary, monkeypatch):
    path = vocabulary("piece_bpe_32k.model")
    rows = token_counts.count_tokens(odd, path, limit=100).collect()
    assert len(rows) == len(ODD)
    assert {(r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows if r["doc_id"] in (1, 2)} == {(0, 0, False)}
    assert [r["over_limit"] for r in rows if r["doc_id"] == 8] == [True]
    assert token_counts.count_tokens(nothing, path).count() == 0
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 3)
    counter = token_counts.PieceCounts(path)
    assert [counter.of(t) for t in ("a b c d e f g", "a b")] == [7, 2] and len(counter) <= 3


# 4 sharding

def test_sharding_law(spark, sf_docs):
    rows = sharding.assign_shards(spark.createDataFrame(list(sf_docs.items()), "doc_id long, text string"), 7).collect()
    sizes, slots = [0] * 7, [[] for _ in range(7)]
    for r in rows:
        assert r["size"] == len(sf_docs[r["key"]].encode()) + 16 and r["text_crc32"] == zlib.crc32(sf_docs[r["key"]].encode())
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)


def test_sharding_hot_group(spark):
    rows = [(i, "the same text again and again") for i in range(3000)] + [(10_000 + i, f"text {i}") for i in range(3000)]
    out = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    sizes = [sum(r["size"] for r in out if r["shard"] == s) for s in range(10)]
    assert len(out) == 6000 and max(sizes) - min(sizes) <= 100
    copies = sorted(r["shard"] for r in out if r["key"] < 10_000)
    assert copies[-1] - copies[0] == len(set(copies)) - 1  # copies lie together


@pytest.mark.parametrize("large", [[503_668], [40_000, 40_000, 9_000], [9_000, 1_200], []])
def test_sharding_records_over_a_share(spark, large):
    texts = [f"{i} " * (20 + i % 50) for i in range(400)] + ["x" * n for n in large]
    rows = sharding.sharded_digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 40).collect()
    shards = [[r for r in rows if r["shard"] == s] for s in range(40)]
    assert len(rows) == len(texts) and all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in shards) and all(shards)
    sizes, left, alone = sorted((r["size"] for r in rows), reverse=True), sum(r["size"] for r in rows), 0
    while sizes[alone] * (40 - alone) > left:
        left, alone = left - sizes[alone], alone + 1
    assert sorted(r["size"] for s in shards if len(s) == 1 for r in s)[::-1][:alone] == sizes[:alone]
    rest = [sum(r["size"] for r in s) for s in shards[:40 - alone]]
    assert max(rest) - min(rest) <= 2 * sizes[alone]


def test_sharding_fewer_rows_than_shards(spark):
    rows = sharding.sharded_digest(spark.createDataFrame([(1, "a" * 100), (2, "b" * 5), (None, None)], "doc_id long, text string"), 8).collect()
    assert len(rows) == 3 and len({r["shard"] for r in rows}) == 3 and {r["slot"] for r in rows} == {0}


def test_sharding_odd_cases(odd, nothing):
    rows = sharding.sharded_digest(odd, 4).collect()
    assert len(rows) == len(ODD) and {r["size"] for r in rows if r["doc_id"] in (1, 2)} == {16}
    assert [r["doc_id"] for r in rows].count(None) == 1
    assert sharding.sharded_digest(nothing, 4).count() == 0


def test_write_shards(odd, spark, tmp_path):
    sharding.write_shards(odd, str(tmp_path / "shards"), 3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == len(ODD) and sorted(str(r["text"]) for r in back.collect()) == sorted(str(t) for _, t in ODD)


# 5 packing

def test_plan_holds_all_lengths():
    rng = random.Random(4)
    for trial in range(20):
        histogram = {}
        for _ in range(rng.randint(1, 400)):
            n = rng.choice([rng.randint(1, 64), rng.randint(1, 10)])
            histogram[n] = histogram.get(n, 0) + rng.choice([1, 1, 50])
        made = packing.plan(dict(histogram), 64)
        held = {}
        for many, contents in made:
            assert sum(n * k for n, k in contents) <= 64
            assert sum(k for n, k in contents if 3 * n > 64) <= 2
            for n, k in contents:
                held[n] = held.get(n, 0) + many * k
        assert held == histogram
        least = max(-(-sum(n * c for n, c in histogram.items()) // 64), sum(c for n, c in histogram.items() if 2 * n > 64))
        assert sum(many for many, _ in made) <= 1.25 * least + 1


def test_packing_digest(spark, odd, nothing, vocabulary):
    path = vocabulary("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    rows = packing.pack_documents(odd, path, 0, 64, with_ids=True).collect()
    for doc_id, text in ODD:
        if doc_id == 10:
            continue
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        own = sorted((r for r in rows if r["doc_id"] == doc_id), key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and all(r["length"] == 64 for r in own[1:])
        assert np.concatenate([np.frombuffer(r["ids"], "<u4") for r in own]).tolist() == ids
        assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and r["length"] <= 64 for r in own)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    packed = packing.pack_documents(odd, path, 0, 64, with_ids=True)
    assert all(len(r["ids"]) == 4 * r["n_tokens"] <= 256 for r in packing.sequences(packed).collect())
    assert packing.pack_documents(nothing, path).count() == 0


def test_byte_bpe_matches_library(vocabulary):
    own = ByteBpe(vocabulary("byte_bpe_50k.json"))
    for text in odd_texts():
        assert own.encode([text])[0].tolist() == own.library.encode(text, add_special_tokens=False).ids, repr(text)


class Counted:
    """A tokenizer whose model notes the words it is given."""

    def __init__(self, library):
        self.library, self.model, self.given = library, self, []
        self.own, self.token_to_id = library.model, library.token_to_id

    def tokenize(self, word):
        self.given.append(word)
        return self.own.tokenize(word)


def test_model_gets_a_pre_token_once(vocabulary):
    own = ByteBpe(vocabulary("byte_bpe_50k.json"))
    own.library = Counted(own.library)
    text = "a zyxwvq, zyxwvq. zyxwvq!) zyxwvq\nzyxwvq"
    assert own.encode([text])[0].tolist() == own.library.library.encode(text, add_special_tokens=False).ids
    assert own.library.given.count("Ġzyxwvq") == 1
    more = "b zyxwvq; qvwxyz"  # the unit with a mark is new, its word is not
    assert own.encode([more])[0].tolist() == own.library.library.encode(more, add_special_tokens=False).ids
    assert own.library.given.count("Ġzyxwvq") == 1 and own.library.given.count("Ġqvwxyz") == 1


class Asked(dict):
    """A dict that notes how often it is asked."""

    asked = 0

    def get(self, key, default=None):
        self.asked += 1
        return super().get(key, default)


def test_cache_is_asked_once_for_a_unit_of_a_call(vocabulary):
    own = ByteBpe(vocabulary("byte_bpe_50k.json"))
    texts = ["to be or\nnot to be " * 500, " to be" * 500, "", "to be"]
    want = [own.library.encode(t, add_special_tokens=False).ids for t in texts]
    own.index = Asked(own.index)
    for _ in range(2):
        own.index.asked = 0
        ids, offsets = own.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want
        assert own.index.asked < 50


def test_byte_bpe_of_many_texts_in_a_call(vocabulary):
    """Units end at white space of any width, texts and added tokens; what a call has learnt holds in the next."""
    own, rng = ByteBpe(vocabulary("byte_bpe_50k.json")), random.Random(11)
    alphabet = [*" \n\t\r\x0b\x85\xa0\u1680\u2003\u2028\u202f\u205f\u3000\x1c\x00ab'sZ7.é日🙂\u200b", "<|endoftext|>", " the", "  ", "'ll"]
    for _ in range(20):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(100)]
        ids, offsets = own.encode(texts)
        assert len(offsets) == len(texts) + 1
        for text, a, b in zip(texts, offsets, offsets[1:]):
            assert ids[a:b].tolist() == own.library.encode(text, add_special_tokens=False).ids, repr(text)
    ids, offsets = own.encode([])
    assert len(ids) == 0 and offsets.tolist() == [0]


def test_full_cache_keeps_units_that_come_again(vocabulary, monkeypatch):
    monkeypatch.setattr("txnscope.llm.byte_bpe.CACHE_UNITS", 200)
    own = ByteBpe(vocabulary("byte_bpe_50k.json"))
    own.library = Counted(own.library)
    common = "x " + " ".join(f"common{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
    for k in range(40):
        text = f"{common} " + " ".join(f"rare{chr(97 + k % 26)}{chr(97 + j)}{'x' * (k // 26)}," for j in range(20))
        assert own.encode([text])[0].tolist() == own.library.library.encode(text, add_special_tokens=False).ids
        assert len(own.index) <= 200
    assert own.library.given.count("Ġcommonaa") == 1


def test_full_cache_is_small(vocabulary):
    """Workers keep it for later tasks, beside the memory of other operators."""
    own = ByteBpe(vocabulary("byte_bpe_50k.json"))
    most = 0
    for k in range(11):
        own.encode(["x " + " ".join(f"{j:x}" for j in range(90_000 * k, 90_000 * (k + 1)))])
        arrays = sum(x.nbytes for x in vars(own).values() if isinstance(x, np.ndarray))
        most = max(most, sys.getsizeof(own.index) + arrays + sum(sys.getsizeof(u) + 32 for u in own.index))
    assert most < 120e6


# 6 token files

def test_block_round_trip_and_checkpoints():
    rng = np.random.default_rng(2)
    for n, lanes in ((1, 1024), (100, 16), (50_000, 64), (70_000, 1024)):
        ids = np.minimum(rng.zipf(1.3, n), 50_000).astype(np.uint32)
        symbols, counts = np.unique(ids, return_counts=True)
        table = ans.Frequencies.scaled_from(symbols.astype(np.int64), counts.astype(float))
        assert int(table.scaled.sum()) == 1 << table.bits and (table.scaled > 0).all()
        payload = ans.encode_block(ids, [(5, 0, n, n)], table, lanes=lanes, every=16)
        entries, back = ans.decode_block(payload, table)
        assert (back == ids).all() and entries["n"].tolist() == [n]
        head, _, checkpoints, words = ans.read_head(payload)
        step = checkpoints[-1][0]  # decoding can start at the last checkpoint alone
        tail = ans.decode_steps(words, checkpoints[-1], -(-n // head["lanes"]), table).ravel()
        assert (tail[:n - step * head["lanes"]] == ids[step * head["lanes"]:]).all()
        if n == 1:
            continue
        broken = bytearray(payload)
        broken[-1] ^= 255
        with pytest.raises((ValueError, IndexError)):
            ans.decode_block(bytes(broken), table)


def test_joined_checksum():
    ids = np.arange(1000, dtype="<u4")
    parts = [(0, 10, zlib.crc32(ids[:10].tobytes())), (310, 690, zlib.crc32(ids[310:].tobytes())), (10, 300, zlib.crc32(ids[10:310].tobytes()))]
    assert ans.joined_crc(parts) == zlib.crc32(ids.tobytes())


@pytest.mark.parametrize("block", [1 << 18, 50])
def test_token_files_round_trip(odd, nothing, vocabulary, monkeypatch, block):
    monkeypatch.setattr(ans, "BLOCK_TOKENS", block)
    path = vocabulary("byte_bpe_50k.json")
    library = ByteBpe(path).library
    rows = sorted((tuple(r) for r in ans.round_trip_digest(odd, path).collect()), key=lambda r: r[1])
    want = sorted(((NO_ID if i is None else i, len(library.encode(t or "", add_special_tokens=False).ids), t or "") for i, t in ODD))
    at = 0
    for doc_id, start, n, crc in rows:
        assert start == at
        at += n
    digest = sorted((str(d), n, c) for d, _, n, c in rows)
    assert digest == sorted((str(None if k == NO_ID else k), n + 1, zlib.crc32(np.array(library.encode(t, add_special_tokens=False).ids + [2], dtype="<u4").tobytes())) for k, n, t in want)
    assert [(-1 if r[0] is None else r[0]) for r in rows] == sorted(-1 if r[0] is None else r[0] for r in rows)
    assert ans.round_trip_digest(nothing, path).count() == 0


# 7 SimHash

def plain_fingerprint(text, shingle=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode()))
    runs = [b" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_fingerprints():
    texts = odd_texts() + ["A b C d", "a B c D e", "x"]
    assert simhash.fingerprints_of(*text_bytes(texts), 4).tolist() == [plain_fingerprint(t) for t in texts]


def smallest_labels(n, edges):
    label = list(range(n))
    while True:
        new = list(label)
        for a, b in edges:
            new[a] = new[b] = min(new[a], new[b])
        if new == label:
            return label
        label = new


@pytest.mark.parametrize("distance, block", [(1, 1 << 14), (4, 3), (4, 1 << 14), (7, 1 << 14)])
def test_pigeonring_loses_no_link(spark, distance, block):
    rng = np.random.default_rng(9)
    fps = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [fps[rng.integers(0, 40)] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, distance + 3), replace=False))) for _ in range(200)]
    every = np.unique(np.concatenate([fps, np.array(near, dtype=np.uint64)]))
    table = spark.createDataFrame([(f, i) for i, f in enumerate(every.view(np.int64).tolist())], "fp long, rep long")
    found = [tuple(r) for r in simhash.links(table, distance, block).collect()]
    assert all(bin(int(every[a] ^ every[b])).count("1") <= distance for a, b in found)
    linked = np.argwhere(np.bitwise_count(every[:, None] ^ every[None, :]) <= distance).tolist()
    assert smallest_labels(len(every), found) == smallest_labels(len(every), linked)


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40)] + [(50, 50 + i) for i in range(1, 60)] + [(rng.randint(120, 160), rng.randint(120, 160)) for _ in range(25)]
    found = dict(map(tuple, connected(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert [found.get(i, i) for i in range(170)] == smallest_labels(170, edges)


def test_simhash_groups(spark, sf_docs):
    out = simhash.near_duplicates(spark.createDataFrame(list(sf_docs.items()), "doc_id long, text string")).collect()
    fps = {d: plain_fingerprint(t) for d, t in sf_docs.items()}
    parent = {d: d for d in fps}
    for a in sorted(fps):
        for b in fps:
            if bin(fps[a] ^ fps[b]).count("1") <= 4:
                x, y = sorted((parent[a], parent[b]))
                if x != y:
                    parent = {d: x if p == y else p for d, p in parent.items()}
    assert {(r["key"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in out} == {(d, fps[d], parent[d]) for d in fps}


def test_simhash_odd_cases(odd, nothing):
    out = simhash.near_duplicates(odd).collect()
    assert len(out) == len(ODD)
    assert {r["component_id"] for r in out if r["key"] in (1, 2, 3)} == {1}
    assert {r["component_id"] for r in out if r["key"] == 11} == {10}
    kept_rows = simhash.keep_one(odd).collect()
    assert sorted(r["text"] for r in kept_rows if r["doc_id"] == 10) == ["other text under the same id", "same text under one id"]
    assert kept_rows[0]["n_words"] == "w" and simhash.keep_one(nothing).count() == 0 == simhash.near_duplicates(nothing).count()


def test_simhash_repeated_and_null_ids(spark):
    texts = {n: " ".join(f"{n}{k}" for k in range(30)) for n in "abcdefg"}
    rows = [(10, "a"), (10, "a"), (11, "a"), (10, "b"), (None, "c"), (None, "d"), (None, "e"), (12, "e"), (13, "f"), (13, "g"), (12, "g"), (None, "c")]
    df = spark.createDataFrame([(i, texts[n], n) for i, n in rows], "doc_id long, text string, name string")
    groups = {n: plain_fingerprint(t) for n, t in texts.items()}
    assert all(bin(x ^ y).count("1") > 8 for a, x in groups.items() for b, y in groups.items() if a < b)
    found = {r["fp"] & (1 << 64) - 1: r["component_id"] for r in simhash.near_duplicates(df).collect()}
    assert {n: found[f] for n, f in groups.items()} == {"a": 10, "b": 10, "c": NO_ID, "d": NO_ID, "e": 12, "f": 13, "g": 12}
    kept_rows = sorted((r["name"], r["doc_id"], r["text"] == texts[r["name"]]) for r in simhash.keep_one(df).collect())
    assert kept_rows == [("a", 10, True), ("b", 10, True), ("c", None, True), ("d", None, True), ("e", 12, True), ("f", 13, True), ("g", 12, True)]


# 8 fingerprints

def test_minhash_likeness(sf_docs):
    texts = [t for t in sf_docs.values() if len(WORD.findall(t)) > 30][:60]
    changed = [minhash.edited(a, b) for a, b in zip(texts, texts[1:])]

    def similarity(a, b):
        A, B = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (WORD.findall(a), WORD.findall(b)))
        return len(A & B) / len(A | B)

    a, b = minhash.signatures(texts[:-1]), minhash.signatures(changed)
    ones = np.ones(len(changed), dtype=bool)
    error = minhash.likeness(a, b, ones, ones) - np.array([similarity(x, y) for x, y in zip(texts, changed)])
    assert abs(error.mean()) < 0.02 and np.abs(error).max() < 0.15


def test_minhash_bias_correction():
    rng = np.random.default_rng(3)
    a, b = (rng.integers(0, 4, (200, 256)).astype(np.uint64) for _ in range(2))
    ones = np.ones(200, dtype=bool)
    assert minhash.likeness(a, b, ones, ones, bits=2).mean() < 0.03
    assert len(minhash.packed(a, 2)[0]) == 128


def test_edit_likeness(spark, sf_docs, odd, nothing):
    rows = {r["doc_id"]: r for r in minhash.edit_likeness(spark.createDataFrame(list(sf_docs.items()), "doc_id long, text string")).collect()}
    ids = sorted(sf_docs)
    assert sorted(rows) == ids
    for i, d in enumerate(ids):
        text, following = sf_docs[d], sf_docs[ids[(i + 1) % len(ids)]]
        changed = minhash.edited(text, following)
        r = rows[d]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == minhash.packed(minhash.signatures([text]))[0]
        assert r["edited_fingerprint"] == minhash.packed(minhash.signatures([changed]))[0]
        assert 0 <= r["near_edited"] <= 1 and (text != following or r["near_next"] == 1)
    assert minhash.edit_likeness(odd).count() == len(ODD) and minhash.edit_likeness(nothing).count() == 0
    single = minhash.edit_likeness(odd.where("doc_id = 4")).first()
    assert single["near_next"] == 1.0
    prints = dict(map(tuple, minhash.fingerprints(odd).where("key in (1, 2, 10, 11)").distinct().where("key != 10").collect()))
    assert prints[1] == prints[2] == "0" * 512 and prints[11] != prints[1]


# 9 decontamination

def test_wand_retrieves_all_above_threshold():
    rng = random.Random(6)
    vocabulary = [f"t{i}" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 12))) for _ in range(90)]
    index = decontaminate.Index(list(range(90)), texts)
    for _ in range(60):
        passage = " ".join(rng.choice(vocabulary) for _ in range(25)) + " " + rng.choice(texts)
        words, _ = decontaminate.plain_words(*text_bytes([passage]))
        terms = sorted(set(index.term_ids(words).tolist()) - {-1})
        scores = np.zeros(90)
        for t in terms:
            for i, s in zip(*index.lists[t]):
                scores[i] += s
        for threshold in (0.2, 0.5, 0.9):
            found = dict(index.search(terms, threshold))
            assert set(found) == set(np.flatnonzero(scores >= threshold).tolist()) or all(abs(scores[i] - threshold) < 1e-9 for i in set(found) ^ set(np.flatnonzero(scores >= threshold).tolist()))
            parts = [hit for lo in range(0, 90, 13) for hit in index.search(terms, threshold, lo, lo + 13)]
            assert {i for i, _ in parts} == set(found)


def test_decontamination(spark, odd, nothing):
    items = spark.createDataFrame([(1, "Who was it that first crossed the wide river at dawn? It was the old ferryman of the northern village."), (2, None), (3, ""), (4, "One sentence of words that is only a question")], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "Noise before it. WHO was it that first crossed the wide river at dawn?   It was the old ferryman of the northern village. " + "noise " * 500),
        (2, "x " * 700 + "one sentence of words that is only a question " + "y " * 700),
        (3, "Who was it that first crossed the wide river at dawn? Somebody else entirely, from another place and time."),
        (4, "It was the old ferryman of the northern village."),
        (5, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r["item_ids"] for r in decontaminate.find_benchmark(docs, items).collect()}
    assert rows == {1: [1], 2: [4], 3: [], 4: [], 5: []}
    assert decontaminate.find_benchmark(odd, items).where("contaminated").count() == 0
    assert decontaminate.find_benchmark(odd, items.limit(0)).count() == len(ODD)
    assert decontaminate.find_benchmark(nothing, items).count() == 0


def test_decontamination_blocks_of_items(spark, monkeypatch):
    rows = [(i, " ".join(f"i{i}w{k}" for k in range(12)) + ". Answer " + " ".join(f"a{i}w{k}" for k in range(4))) for i in range(30)]
    items = spark.createDataFrame(rows, "item_id long, text string")
    docs = spark.createDataFrame([(i, "lead " * 40 + t) for i, t in rows], "doc_id long, text string")
    both = spark.createDataFrame([(100, "lead " * 9 + rows[3][1] + " between " * 9 + rows[29][1]), (100, "lead " * 9 + rows[3][1] + " between " * 9 + rows[29][1]), (101, None)], docs.schema)
    docs = docs.union(both)
    expected = sorted([(i, [i]) for i in range(30)] + [(100, [3, 29])] * 2 + [(101, [])])
    whole = {r["doc_id"]: r["best_score"] for r in decontaminate.find_benchmark(docs, items).collect()}
    assert all(s > 0.99 for i, s in whole.items() if i != 101) and whole[101] == 0.0
    for limit, most in (("INDEX_ITEMS", 7), ("INDEX_BYTES", 400)):  # several passes
        with monkeypatch.context() as m:
            m.setattr(decontaminate, limit, most)
            assert sorted((r["doc_id"], r["item_ids"]) for r in decontaminate.find_benchmark(docs, items).collect()) == expected


def test_decontamination_scores_do_not_depend_on_the_passes(spark, monkeypatch):
    rng = random.Random(11)
    common = [f"c{k}" for k in range(12)]
    texts = [" ".join(rng.choice(common) if rng.random() < 0.6 else f"r{rng.randint(0, 150)}" for _ in range(rng.randint(8, 40))) + ". Answer " + " ".join(rng.choices(common, k=3)) for _ in range(60)]
    items = spark.createDataFrame([*enumerate(texts), (60, texts[0]), (None, texts[1]), (61, None), (62, "?")], "item_id long, text string")
    edited = []
    for t in texts:
        for share in (0.03, 0.1, 0.25):
            edited.append("lead " * rng.randint(0, 60) + " ".join(f"x{rng.randint(0, 9)}" if rng.random() < share else w for w in t.split()) + " trail" * rng.randint(0, 60))
    docs = spark.createDataFrame(list(enumerate(edited)), "doc_id long, text string")

    def found():
        out = decontaminate.find_benchmark(docs, items, share=0.1)
        return {r["doc_id"]: (r["item_ids"], r["best_score"]) for r in out.collect()}

    whole = found()
    assert sum(0.65 <= score < 0.99 for _, score in whole.values()) > 20 and any(not hits for hits, _ in whole.values())
    for limit, most in (("INDEX_ITEMS", 25), ("INDEX_BYTES", 3000)):
        with monkeypatch.context() as m:
            m.setattr(decontaminate, limit, most)
            assert found() == whole


# 10 licences

def test_license_rules(spark, odd, nothing):
    docs = spark.createDataFrame([
        (1, "Text.\nReleased under the MIT License."),
        (2, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.\nThe above copyright notice and this permission notice "
            "shall be included in all copies or substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED."),
        (3, "Copyright 2020 Someone. All rights reserved. Licensed under the Apache License, Version 2.0."),
        (4, "We discuss the MIT License and how it was released."),
        (5, "Licensed under CC BY-NC 4.0.")], "doc_id long, text string")
    rows = {r["doc_id"]: r["licenses"] for r in licenses.scan_licenses(docs).collect()}
    assert rows == {1: ["MIT"], 2: ["MIT"], 3: ["Apache-2.0", "proprietary"], 4: [], 5: ["CC-BY-NC-4.0"]}
    assert licenses.scan_licenses(odd).where("n_license_sentences > 0").count() == 0
    assert licenses.scan_licenses(nothing).count() == 0


MIT_TEXT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
BSD_TEXT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer."""
APACHE_TEXT = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS."""
GPL_TEXT = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
LGPL_TEXT = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
MPL_TEXT = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""


def test_license_hard_wrapped(spark):
    texts = {MIT_TEXT: (["copyright", "mit-grant", "mit-condition", "as-is"], ["MIT"]), BSD_TEXT: (["bsd-grant"], ["BSD"]),
             "Copyright (c) 1999, Someone.\nAll rights reserved.\n\n" + BSD_TEXT: (["copyright", "reserved", "bsd-grant"], ["BSD", "proprietary"]),
             APACHE_TEXT: (["apache-notice-2", "apache-use", "apache-copy"], ["Apache-2.0"]), GPL_TEXT: (["gpl3-free", "gpl-hope"], ["GPL"]),
             LGPL_TEXT: (["lgpl-free"], ["LGPL"]), MPL_TEXT: (["mpl-notice"], ["MPL-2.0"])}
    shapes = [lambda t: t, lambda t: t.replace("\n", "\r\n"), lambda t: "/*\n" + "\n".join(f" * {x}" for x in t.split("\n")) + "\n */\nint x;",
              lambda t: "\n".join(f"# {x}".rstrip() for x in t.split("\n")), lambda t: "\n".join(f"// {x}" for x in t.split("\n")),
              lambda t: "\n".join(f"dnl {x}" for x in t.split("\n")), lambda t: "\n\n".join(" ".join(x.split()) for x in t.split("\n\n"))]
    rows = [(i, shape(t)) for i, (t, shape) in enumerate((t, shape) for t in texts for shape in shapes)]
    out = {r["doc_id"]: (r["sentence_ids"], r["licenses"]) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[i] for i, _ in rows] == [want for want in texts.values() for _ in shapes]


def test_license_marks_and_versions(spark):
    texts = ["| a | b |\nAll rights\nreserved.", "All rights. Reserved.", "All rights\n\nreserved.", "License: released under the MIT License; see below",
             "Licensed under the Apache License, Version 1.1.", "This work is licensed under the GNU General Public License, version 2.",
             "Licensed under\nCC BY-SA 3.0.", "You may obtain a copy of the License at", "Licensed under CC BY 2.5. Licensed under CC BY 4.0."]
    out = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["licenses"] for r in out] == [["proprietary"], [], [], ["MIT"], ["Apache-1.1"], ["GPL-2.0"], ["CC-BY-SA-3.0"], [], ["CC-BY-4.0", "CC-BY-2.5"]]
    assert [r["sentence_ids"] for r in out][4:8] == [["apache-version-1.1"], ["gpl-version-2.0"], ["cc-by-sa-version-3.0"], ["apache-copy"]]


def test_every_known_sentence_has_a_hint():
    for text in licenses.SENTENCES.values():
        assert re.search(licenses.HINT.replace("(?i)", ""), text, re.I), text
    assert {i for _, rule in licenses.RULES for i in rule} <= set(licenses.SENTENCES)


def test_license_scan_matches_oracle(spark):
    from oracle_compare import duck, rows_of

    ours = QUERIES["op10_license_scan"](spark, SF_SMALL).toPandas()
    assert rows_of(ours) == rows_of(duck(SF_SMALL).execute(licenses.oracle_sql()).df())
