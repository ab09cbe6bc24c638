"""Token counts of a sentencepiece BPE model by heap-and-linked-list merging.

No identifiers are made: a word's count is its initial symbols minus its merges.
A character outside the vocabulary is as many symbols as it has UTF-8 bytes (byte
fallback) and never merges.  No piece has a space mark behind another character, so
runs of space marks with the characters behind them ("words") merge on their own and
are counted once per worker while a bounded cache holds them.
"""

from __future__ import annotations

import heapq
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.llm.tables import bounded_batches, keyed, relaxed, with_columns

MARK = "▁"  # the space mark of the vocabulary
CACHE_WORDS = 1_200_000
_WORD = re.compile(" *[^ ]+| +")


class PieceCounts(dict):
    """word (space marks as spaces) -> number of tokens; computes what is missing."""

    def __init__(self, model: str):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        self.cost = {}
        for i in range(processor.get_piece_size()):
            if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i) or processor.is_unused(i)):
                self.cost[processor.id_to_piece(i).replace(MARK, " ")] = -processor.get_score(i)
        if any("\n" in p for p in self.cost):
            raise ValueError("expected a model without line feeds in its pieces")
        odd = next((p for p in self.cost if " " in p.lstrip(" ")), None)
        if odd is not None or processor.encode("a", out_type=str) != [MARK + "a"] or processor.encode("ﬁ  A", out_type=str)[-1] != MARK + "A":
            raise ValueError("expected a model that adds a leading space mark, keeps texts unchanged and has no space mark inside a piece")

    def __missing__(self, word: str) -> int:
        """``word`` has a space before it in the text, unless it begins with a line feed."""
        n = self.merged(word if word[:1] == "\n" else " " + word)
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = n
        return n

    def merged(self, word: str) -> int:
        """Initial symbols minus merges; pairs are popped by cost, then from the left."""
        cost, symbols, size = self.cost, list(word), len(word)
        look = cost.get
        count = size
        for c in symbols:
            if c not in cost:
                count += len(c.encode("utf-8", "surrogatepass")) - 1
        heap = []
        for i in range(size - 1):
            price = look(symbols[i] + symbols[i + 1])
            if price is not None:
                heap.append((price, i, i + 1, 2))
        heapq.heapify(heap)
        after, before, pop, push = list(range(1, size + 1)), list(range(-1, size - 1)), heapq.heappop, heapq.heappush
        while heap:
            _, i, j, length = pop(heap)
            left, right = symbols[i], symbols[j]
            if not left or not right or len(left) + len(right) != length:
                continue  # one of the two has merged since
            symbols[i] = joined = left + right
            symbols[j] = ""
            count -= 1
            k = after[i] = after[j]
            if k < size:
                before[k] = i
                pair = joined + symbols[k]
                price = look(pair)
                if price is not None:
                    push(heap, (price, i, k, len(pair)))
            h = before[i]
            if h >= 0:
                pair = symbols[h] + joined
                price = look(pair)
                if price is not None:
                    push(heap, (price, h, i, len(pair)))
        return count

    def of(self, text: str) -> int:
        """Tokens of a whole text; an empty text has none."""
        if not text:
            return 0
        text = text.replace(MARK, " ")
        cut = text.replace("\n", " \n")  # a line feed never merges with what is before it
        if text[0] in " \n" or "  " in cut or cut[-1] == " ":
            return sum(self[w[1:]] if w[1:2] not in ("", " ", "\n") else self.merged(w) for w in _WORD.findall(" " + text))
        return sum(map(self.__getitem__, cut.split(" ")))


_counters: dict[str, PieceCounts] = {}


def counter(model: str) -> PieceCounts:
    """One counter per worker process and model."""
    if model not in _counters:
        _counters[model] = PieceCounts(model)
    return _counters[model]


def count_tokens(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """``df`` without its text, with n_bytes, n_tokens (long) and over_limit (n_tokens > limit).

    A null or empty text has 0 of both; rows with null or repeated ids are counted each; columns of ``df`` that bear
    a result's name are replaced by it.  The token rule is the model's own, without begin, end or special tokens.
    No shuffle: one pass over the texts.
    """
    bounded_batches(df.sparkSession)
    light = [c for c in df.columns if c != text_col]
    rows = keyed(df, id_col, text_col).select(F.struct(*[F.col(f"row.`{c}`") for c in light]).alias("row"), "text")
    schema = rows.schema["row"].dataType.simpleString()

    def run(batches):
        tokens = counter(model)
        for batch in batches:
            text = batch.column("text")
            counts = [tokens.of(t.as_py()) for t in text]
            yield pa.record_batch([relaxed(batch.column("row")), pc.cast(pc.binary_length(text), pa.int64()), pa.array(counts, pa.int64())],
                                  names=["row", "n_bytes", "n_tokens"])

    out = rows.mapInArrow(run, f"row {schema}, n_bytes long, n_tokens long")
    return with_columns(out, light, n_bytes=F.col("n_bytes"), n_tokens=F.col("n_tokens"), over_limit=F.col("n_tokens") > limit)
