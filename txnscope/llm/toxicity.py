"""Toxic spans by a linear-chain conditional random field over words.

Labels mark documents, so token labels come first: a feature (a word, or a prefix of one) is
evidence of toxicity if it is much more frequent in toxic documents than in clean ones, and a
word of a toxic document with such a feature is a toxic token.  A CRF with two states is
trained on these tokens; forward-backward gives each word's marginal, all of a slice in array
operations: runs of words become 2x2 transfer matrices, joined by a short scan.  A document's
score is a logistic function of its marginals; words at or above one half form its spans.

Fitting takes at most ``FIT_DOCUMENTS`` labelled documents of a class (those with the
smallest hash of their id, texts of at most ``FIT_BYTES``).  Scoring reads every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.llm.tables import bounded_batches, keyed, relaxed, with_columns
from txnscope.llm.words import column_bytes, hash_spans, mix, text_bytes, word_spans

FIT_DOCUMENTS = {1: 800, 0: 1000}
FIT_BYTES = 1 << 15
PREFIXES = (4, 5, 6, 8)  # bytes
SEED_SHARE, SEED_SURPRISE = 0.9, 15.0

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_MARKS = np.zeros(256, dtype=bool)
_MARKS[[ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = True


def trimmed(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans without ASCII marks at either end (up to four on each side; a word of marks keeps its first)."""
    starts, ends = starts.copy(), ends.copy()
    for _ in range(4):
        if not len(starts):
            break
        starts += _MARKS[buf[starts]] & (ends - starts > 1)
        ends -= _MARKS[buf[ends - 1]] & (ends - starts > 1)
    return starts, ends


def word_features(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(kind, word) -> hash: the whole word and its prefixes (0 where the word is no longer than the prefix)."""
    starts, ends = trimmed(buf, starts, ends)
    rows = [hash_spans(buf, starts, ends)]
    for n in PREFIXES:
        long = ends - starts > n
        row = np.zeros(len(starts), dtype=np.uint64)
        row[long] = mix(hash_spans(buf, starts[long], starts[long] + n) + np.uint64(n))
        rows.append(row)
    return np.stack(rows)


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray  # what each adds to the toxic state's score
    bias: float
    start: np.ndarray  # chances of the two states at a document's first word
    move: np.ndarray  # state -> next state
    final: np.ndarray  # logistic weights of a document: constant, largest marginal's logit, log(1 + expected toxic words)

    def emissions(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Toxic score less clean score of each word."""
        out = np.full(len(starts), self.bias)
        if not len(self.features):
            return out
        maybe = np.zeros(1 << 16, dtype=bool)
        maybe[(self.features >> np.uint64(48)).astype(np.int64)] = True
        for row in word_features(buf, starts, ends):
            at = np.flatnonzero(maybe[(row >> np.uint64(48)).astype(np.int64)])
            place = np.minimum(np.searchsorted(self.features, row[at]), len(self.features) - 1)
            known = self.features[place] == row[at]
            out[at[known]] += self.weights[place[known]]
        return out


def marginals(emission: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray) -> np.ndarray:
    """P(toxic) of every word; ``first`` has each document's first word, chains do not cross documents.

    Words are laid out in lanes that advance in step.  A lane's product of transfer matrices carries the
    message across it, so the only loops are over the steps of a lane and over the lanes.
    """
    n = len(emission)
    if not n:
        return np.zeros(0)
    lanes = max(1, int(1.5 * np.sqrt(n)))
    steps = -(-n // lanes)
    e = np.zeros(lanes * steps)
    e[:n] = np.clip(emission, -30, 30)
    toxic = np.exp(-np.logaddexp(0, -e))  # shares of the states, so that no product overflows
    weight = np.stack([1 - toxic, toxic])
    fresh = np.zeros(lanes * steps, dtype=bool)
    fresh[first[:-1][first[:-1] < first[1:]]] = True
    # entries of each word's transfer matrix, (state before, state) -> (step, lane)
    m = [[np.ascontiguousarray((np.where(fresh, start[j], move[i, j]) * weight[j]).reshape(lanes, steps).T) for j in (0, 1)] for i in (0, 1)]
    (m00, m01), (m10, m11) = m
    p00, p01, p10, p11 = np.ones(lanes), np.zeros(lanes), np.zeros(lanes), np.ones(lanes)
    for t in range(steps):
        p00, p01 = p00 * m00[t] + p01 * m10[t], p00 * m01[t] + p01 * m11[t]
        p10, p11 = p10 * m00[t] + p11 * m10[t], p10 * m01[t] + p11 * m11[t]
        if t % 8 == 7:
            total = p00 + p01 + p10 + p11
            p00, p01, p10, p11 = p00 / total, p01 / total, p10 / total, p11 / total
    ahead, behind = np.empty((lanes, 2)), np.empty((lanes, 2))
    ahead[0], behind[-1] = start, 0.5
    product = list(zip(p00.tolist(), p01.tolist(), p10.tolist(), p11.tolist()))
    x, y = float(start[0]), float(start[1])
    for lane in range(1, lanes):
        a, b, c, d = product[lane - 1]
        x, y = x * a + y * c, x * b + y * d
        x, y = x / (x + y), y / (x + y)
        ahead[lane] = x, y
    x = y = 0.5
    for lane in range(lanes - 2, -1, -1):
        a, b, c, d = product[lane + 1]
        x, y = a * x + b * y, c * x + d * y
        x, y = x / (x + y), y / (x + y)
        behind[lane] = x, y
    forward = np.empty((2, steps, lanes))
    f0, f1 = ahead.T.copy()
    for t in range(steps):
        f0, f1 = f0 * m00[t] + f1 * m10[t], f0 * m01[t] + f1 * m11[t]
        total = f0 + f1
        forward[0, t], forward[1, t] = f0, f1 = f0 / total, f1 / total
    out = np.empty((steps, lanes))
    b0, b1 = behind.T.copy()
    for t in range(steps - 1, -1, -1):
        one = forward[1, t] * b1
        out[t] = one / (forward[0, t] * b0 + one)
        b0, b1 = m00[t] * b0 + m01[t] * b1, m10[t] * b0 + m11[t] * b1
        total = b0 + b1
        b0, b1 = b0 / total, b1 / total
    return out.T.ravel()[:n]


def document_features(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(constant, logit of the largest marginal, log(1 + expected number of toxic words)) of each document."""
    filled = first[:-1] < first[1:]
    most, total = np.full(len(filled), 1e-6), np.zeros(len(filled))
    if filled.any():
        at = first[:-1][filled]
        most[filled] = np.maximum.reduceat(p, at)
        total[filled] = np.add.reduceat(np.where(p >= 0.01, p, 0.0), at)
    most = np.clip(most, 1e-6, 1 - 1e-6)
    return np.stack([np.ones(len(most)), np.log(most / (1 - most)), np.log1p(total)], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0, -x))


def fit(texts: list[str], toxic: np.ndarray, clean_weight: float = 1.0, rounds: int = 25) -> Model:
    """The model of labelled texts; without texts of both classes every document gets the share of toxic ones.

    ``clean_weight`` is how many clean documents each clean text stands for, for one that a toxic text does.
    """
    start, move = np.array([0.98, 0.02]), np.array([[0.98, 0.02], [0.6, 0.4]])
    toxic = np.asarray(toxic, dtype=bool)
    stands = np.where(toxic, 1.0, clean_weight)
    share = ((toxic * stands).sum() + 1.0) / (stands.sum() + 2.0)
    if not toxic.any() or toxic.all():
        return Model(np.zeros(0, np.uint64), np.zeros(0), -6.0, start, move, np.array([np.log(share / (1 - share)), 0.0, 0.0]))
    buf, offsets = text_bytes(texts)
    buf = _LOWER[buf]
    starts, ends, first = word_spans(buf, offsets)
    rows = word_features(buf, starts, ends)
    document = np.repeat(np.arange(len(texts)), np.diff(first))

    # evidence: documents of each class with a feature against the share of toxic ones, as a likelihood ratio
    kept, strong, base = [], [], toxic.mean()
    for row in rows:
        feature, inverse = np.unique(row, return_inverse=True)
        pair = np.unique(inverse * len(texts) + document)
        inverse, owner = pair // len(texts), pair % len(texts)
        n1 = np.bincount(inverse, weights=toxic[owner], minlength=len(feature))
        n0 = np.bincount(inverse, minlength=len(feature)) - n1
        p = (n1 + 1e-9) / (n1 + n0 + 2e-9)
        surprise = n1 * np.log(p / base) + n0 * np.log((1 - p + 1e-12) / (1 - base))
        seed = (p >= SEED_SHARE) & (surprise >= SEED_SURPRISE) & (feature != 0)
        usual = (n1 + n0 >= max(20, 0.01 * len(texts))) & (feature != 0)
        kept.append(feature[seed | usual])
        strong.append(seed[seed | usual])
    features, at = np.unique(np.concatenate(kept), return_index=True)
    seed = np.concatenate(strong)[at]
    if not len(features):
        return Model(np.zeros(0, np.uint64), np.zeros(0), -6.0, start, move, np.array([np.log(share / (1 - share)), 0.0, 0.0]))
    place = np.minimum(np.searchsorted(features, rows), len(features) - 1)
    known = features[place] == rows
    label = (known & seed[place]).any(axis=0) & toxic[document]

    # gradient steps on the chains' log-likelihood: observed less expected counts
    weights, bias, step, seen = np.zeros(len(features)), -4.0, 0.5, np.full(len(features) + 1, 1e-8)
    word = np.broadcast_to(np.arange(len(starts)), rows.shape)[known]
    index = place[known]
    weights += np.where(seed, 2.0, -0.5)
    begins = first[:-1][first[:-1] < first[1:]]
    follows = np.ones(len(label), dtype=bool)
    follows[begins] = False
    follows = np.flatnonzero(follows)
    pairs = np.bincount(label[follows - 1] * 2 + label[follows], minlength=4).reshape(2, 2) + np.array([[1.0, 1.0], [1.0, 1.0]])
    move = pairs / pairs.sum(axis=1, keepdims=True)
    start = np.array([(~label[begins]).sum() + 1.0, label[begins].sum() + 1.0])
    start /= start.sum()
    decay = 1e-3
    for _ in range(rounds):
        emission = bias + np.bincount(word, weights=weights[index], minlength=len(starts))
        gap = label - marginals(emission, first, start, move)
        pull = np.append(np.bincount(index, weights=gap[word], minlength=len(features)) - decay * weights * len(starts) ** 0.5, gap.sum())
        seen += pull * pull
        change = step * pull / np.sqrt(seen)
        weights += change[:-1]
        bias += change[-1]
    model = Model(features, weights, float(bias), start, move, np.zeros(3))
    emission = bias + np.bincount(word, weights=weights[index], minlength=len(starts))
    x = document_features(marginals(emission, first, start, move), first)
    return Model(features, weights, float(bias), start, move, _logistic(x, toxic, stands))


def _logistic(x: np.ndarray, y: np.ndarray, stands: np.ndarray) -> np.ndarray:
    """Logistic weights, shrunk towards the marginal's own logit; evidence never counts against toxicity."""
    prior, pull = np.array([0.0, 1.0, 0.0]), np.array([0.01, 0.5, 0.5])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((stands * np.logaddexp(0, np.where(y, -z, z))).sum() + (pull * (w - prior) ** 2).sum() / 2)

    w, best = prior, loss(prior)
    for _ in range(40):
        chance = _sigmoid(x @ w)
        slope = x.T @ (stands * (chance - y)) + pull * (w - prior)
        bend = (x * (stands * chance * (1 - chance))[:, None]).T @ x + np.diag(pull)
        change, size = np.linalg.solve(bend, slope), 1.0
        while size > 1e-4:  # halve the Newton step until it helps
            nearer = w - size * change
            nearer[1:] = np.maximum(nearer[1:], 0.0)
            if (now := loss(nearer)) < best:
                break
            size /= 2
        else:
            return w
        w, best = nearer, now
    return w


def fit_sample(labelled: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[list[str], np.ndarray]:
    """At most ``FIT_DOCUMENTS`` rows of each class, by the hash of the id."""
    texts, marks = [], []
    for mark in (0, 1):
        rows = labelled.where((F.col(label_col) == mark) & (F.octet_length(text_col) <= FIT_BYTES)).select(text_col, id_col) \
            .orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col, text_col).limit(FIT_DOCUMENTS[mark]).collect()
        texts += [r[text_col] or "" for r in rows]
        marks += [mark] * len(rows)
    return texts, np.array(marks, dtype=bool)


def score_slice(model: Model, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list[dict]]]:
    """(score, spans) of each text; spans are in code points, with the mean marginal."""
    lower = _LOWER[buf]
    starts, ends, first = word_spans(lower, offsets)
    p = marginals(model.emissions(lower, starts, ends), first, model.start, model.move)
    score = _sigmoid(document_features(p, first) @ model.final)
    spans: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
    flagged = np.flatnonzero(p >= 0.5)
    if len(flagged):
        character = np.cumsum((buf & 0xC0) != 0x80)  # code points up to each byte, itself included
        owner = np.searchsorted(first, flagged, side="right") - 1
        new = np.flatnonzero((np.diff(flagged, prepend=-2) != 1) | (np.diff(owner, prepend=-1) != 0))
        for a, b in zip(new.tolist(), [*new[1:].tolist(), len(flagged)]):
            d, s, e = int(owner[a]), int(starts[flagged[a]]), int(ends[flagged[b - 1]])
            base = int(character[offsets[d] - 1]) if offsets[d] else 0
            spans[d].append({"start": int(character[s]) - 1 - base, "end": int(character[e - 1]) - base, "p": float(p[flagged[a:b]].mean())})
    return score, spans


def score_toxicity(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with score (0 to 1), predicted (1 if score >= 0.5, else 0) and spans (start, end, p); no shuffle.

    A null or empty text has no words: it gets the score of a document without evidence and no spans.  Labels,
    ids and other columns are not read for a score; columns of ``df`` that bear a result's name are replaced by it.
    """
    bounded_batches(df.sparkSession)
    rows = keyed(df, id_col, text_col).select("row", "text")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches):
        for batch in batches:
            buf, offsets = column_bytes(batch.column("text"))
            lo = 0
            while lo < batch.num_rows:  # about 1 MB of text at a time
                hi = min(batch.num_rows, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + (1 << 20))) - 1))
                score, spans = score_slice(model, buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                yield pa.record_batch([relaxed(batch.column("row").slice(lo, hi - lo)), pa.array(score), pa.array(spans, kind)], names=["row", "score", "spans"])
                lo = hi

    out = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double, spans array<struct<start:int,end:int,p:double>>")
    return with_columns(out, df.columns, score=F.col("score"), predicted=(F.col("score") >= 0.5).cast("int"), spans=F.col("spans"))


def held_out(id_col: str):
    """Whether an id belongs to the fold that nothing is learnt from."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 5 == 0


def trained(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """The model fitted on labelled documents outside the held-out fold.

    Rows without an id or a label, and ids without a document or a text, teach nothing; an id labelled both ways counts as toxic.
    """
    marked = labels.where(F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias(label_col))
    # labels whose documents can be in the sample; their number is bounded, so the texts are found by a semi-join on few ids
    chosen = None
    for mark in (0, 1):
        few = marked.where(F.col(label_col) == mark).orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).limit(2 * FIT_DOCUMENTS[mark])
        chosen = few if chosen is None else chosen.union(few)
    joined = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col)
    texts, toxic = fit_sample(joined, id_col, text_col, label_col)
    all_of = {int(r[0]): r[1] for r in marked.groupBy(label_col).count().collect()}  # a row for each label value
    weight = (all_of.get(0, 0) / max(1, (~toxic).sum())) / max(1e-9, all_of.get(1, 0) / max(1, toxic.sum())) if toxic.any() else 1.0
    return fit(texts, toxic, weight)
