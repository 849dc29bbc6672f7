"""Benchmark decontamination: pigeonhole pieces, then Myers' bit-parallel distance."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop_written, grams, ship, token_hashes, written

#: Share of an item's words that may differ: similarity of 0.8 or more.
ERROR_RATE = 0.2
#: Items of fewer words are matched as they are, without an error.
MIN_WORDS = 5
#: Characters of benchmark text that tasks hold at a time; a larger benchmark is matched in blocks of this size.
BLOCK_CHARS = 16_000_000
_TABLE_BITS = 22
#: Scripts that do not part words by spaces: Thai, Lao, Tibetan, Myanmar, Khmer, Tai Le to Tai Tham, Kana, Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u1950-\u1aaf\u3005-\u3007\u3031-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def spaced(text: str | None) -> str | None:
    """text with spaces for all Unicode marks (punctuation, symbols, separators) beyond ASCII, and around each character
    of a script that has no spaces, which so is a word."""
    if not text or text.isascii():
        return text
    for c in set(text):
        if c > "\x7f" and unicodedata.category(c)[0] in "PSZ":
            text = text.replace(c, " ")
    return _UNSPACED.sub(r" \g<0> ", text)


def _words(texts: list[str | None]) -> Iterator[tuple[int, list[np.ndarray]]]:
    return token_hashes([spaced(t) for t in texts], words_only=True)


def distance_in(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance between pattern and any stretch of text, and the (first) word behind that stretch.

    Myers' bit-parallel search with words as symbols; Python's integers are the bit vectors, so a pattern may have
    any length.
    """
    m = len(pattern)
    masks: dict[int, int] = {}
    for i, w in enumerate(pattern.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << m - 1
    up, down, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text.tolist(), 1):
        eq = masks.get(w, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        rise = down | (full & ~(diagonal | up))
        fall = up & diagonal
        score += (rise & top > 0) - (fall & top > 0)
        rise, fall = rise << 1 & full, fall << 1 & full
        up, down = fall | (full & ~(diagonal | rise)), rise & diagonal
        if score < best:
            best, end = score, j
    return best, end


class Pieces:
    """A block of benchmark items, each split into one piece more than the words that may differ: a stretch of text
    within that distance holds at least one piece unchanged. It is made once and sent to tasks as arrays: the hashes of
    all pieces in order, with the item and the place in it of each."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float, min_words: int):
        self.ids: list[int | None] = []
        self.budgets: list[int] = []
        words_of, keys, at = [], [], []
        for begin, each in _words([t for _, t in items]):
            for i, words in enumerate(each):
                if not len(words):
                    continue
                budget = int(len(words) * rate) if len(words) >= min_words else 0
                cuts = [len(words) * k // (budget + 1) for k in range(budget + 2)]
                for a, b in zip(cuts, cuts[1:]):
                    keys.append(grams(words[a:b], b - a)[0])
                    at.append((len(words_of), a, b - a))
                self.ids.append(items[begin + i][0])
                self.budgets.append(budget)
                words_of.append(words)
        order = np.argsort(np.array(keys, dtype=np.uint64), kind="stable")
        self.keys = np.array(keys, dtype=np.uint64)[order]
        self.item, self.offset, length = np.array(at, dtype=np.int32).reshape(-1, 3)[order].T.copy()
        self.lengths = np.unique(length).tolist()
        self.words = np.concatenate(words_of) if words_of else np.empty(0, dtype=np.uint64)
        self.ends = np.cumsum([len(w) for w in words_of], dtype=np.int64)
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[self.keys >> np.uint64(64 - _TABLE_BITS)] = True

    def item_words(self, item: int) -> np.ndarray:
        return self.words[self.ends[item - 1] if item else 0 : self.ends[item]]

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of hashes those that are some piece's: their numbers, and where such pieces begin in keys."""
        at = np.flatnonzero(self.table[hashes >> np.uint64(64 - _TABLE_BITS)])
        first = np.searchsorted(self.keys, hashes[at])
        there = self.keys[np.minimum(first, len(self.keys) - 1)] == hashes[at] if len(self.keys) else np.zeros(0, dtype=bool)
        return at[there], first[there]

    def places(self, words: np.ndarray) -> dict[int, set[int]]:
        """For each item of which a run of words holds a piece: where the item would begin."""
        found: dict[int, set[int]] = {}
        for n in self.lengths:
            g = grams(words, n)
            at, first = self.hits(g)
            last = np.searchsorted(self.keys, g[at], side="right")
            for p, i, j in zip(at.tolist(), first.tolist(), last.tolist()):
                for item, a in zip(self.item[i:j].tolist(), self.offset[i:j].tolist()):
                    found.setdefault(item, set()).add(p - a)
        return found

    def matches(self, words: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item, distance, begin, end) of each item's best match in a text's words.

        Windows around the places overlap where a text repeats a piece; what they cover is searched once, so the work
        for an item is at most in proportion to the text.
        """
        found: dict[int, tuple[int, int, int]] = {}
        for item, begins in self.places(words).items():
            pattern, budget = self.item_words(item), self.budgets[item]
            for low, high in joined_windows(begins, budget, len(pattern) + budget, len(words)):
                distance, end = distance_in(pattern, words[low:high])
                if distance <= budget:
                    back, length = distance_in(pattern[::-1], words[max(low, low + end - len(pattern) - budget) : low + end][::-1])
                    start = end - length if back == distance else max(0, end - len(pattern))
                    found[item] = min(found.get(item, (1 << 30, 0, 0)), (distance, low + start, low + end))
        return [(item, *f) for item, f in sorted(found.items())]


def joined_windows(begins: set[int], before: int, behind: int, size: int) -> Iterator[tuple[int, int]]:
    """The windows [begin - before, begin + behind) inside [0, size), overlapping ones as one."""
    low = high = -1
    for begin in sorted(begins):
        a, b = max(0, begin - before), min(size, begin + behind)
        if a > high:
            if high > low:
                yield low, high
            low = a
        high = max(high, b)
    if high > low:
        yield low, high


def matched(texts: list[str | None], pieces: Pieces) -> list[list[tuple[int, int, int, int]]]:
    """The matches in each text. Pieces are looked up over many texts at once; texts that hold one are verified."""
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
    longest = max(pieces.lengths, default=0)
    gap = np.zeros(longest, dtype=np.uint64)  # no run of words reaches from one text into the next
    for begin, each in _words(texts):
        joined = np.concatenate([x for words in each for x in (words, gap)])
        ends = np.cumsum([len(words) + longest for words in each])
        hit: set[int] = set()
        for n in pieces.lengths:
            at, _ = pieces.hits(grams(joined, n))
            hit.update(np.searchsorted(ends, at, side="right").tolist())
        for i in hit:
            out[begin + i] = pieces.matches(each[i])
    return out


def blocks_of(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items in blocks of about block_chars characters, so that what is sent to tasks is bounded."""
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    size = items.agg(F.sum(F.length("text").cast("long")).alias("n")).first()["n"] or 0
    n = -(-size // block_chars)
    for b in range(n):
        rows = items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(n)) == b).collect()
        yield sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def find_contamination(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, min_words: int = MIN_WORDS) -> DataFrame:
    """Every (document, benchmark item) where the document holds the item with at most rate of its words changed.

    Words are lower-cased runs of letters and digits, and single characters of scripts without spaces; changed means replaced, added or left out (edit distance over
    words, anywhere in the whole text). Returns doc_id, item_id, item_words, distance, start_word and end_word of the
    best match (the leftmost of equals). docs needs doc_id and text, benchmark item_id and text; other columns are
    ignored. The benchmark is sent to tasks in blocks of bounded size, each matched against all documents; documents
    are never shuffled. Of several blocks one is held at a time: its matches are written before the next one is sent.

    Defined cases: null and empty texts match nothing; items of fewer than min_words words are searched without an error; repeated
    items count once, repeated documents are each reported; null ids are reported as null; an empty benchmark or table
    gives no rows.
    """
    ship(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = ["doc_id", "item_id", "item_words", "distance", "start_word", "end_word"]
    out, blocks = None, blocks_of(benchmark)
    items = next(blocks, None)
    while items is not None:
        sent = docs.sparkSession.sparkContext.broadcast(Pieces(items, rate, min_words))

        def match(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            pieces = sent.value
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [
                    (ids[i], pieces.ids[k], len(pieces.item_words(k)), distance, start, end)
                    for i, found in enumerate(matched(batch.column(1).to_pylist(), pieces))
                    for k, distance, start, end in found
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 6, names=names)

        part = slim.mapInArrow(match, ", ".join(f"{n} bigint" for n in names))
        items = next(blocks, None)
        if items is not None or out is not None:
            part = written(part, "matches")
            sent.destroy()
        out = part if out is None else out.unionByName(part)
    return slim.sparkSession.createDataFrame([], ", ".join(f"{n} bigint" for n in names)) if out is None else out


def _holder(sent):
    @F.pandas_udf("boolean")
    def holds(each: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in each:
            yield pd.Series([bool(m) for m in matched([t if isinstance(t, str) else None for t in texts], sent.value)], dtype=bool)

    return holds


def decontaminate(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, min_words: int = MIN_WORDS) -> DataFrame:
    """docs without the documents that find_contamination would report, all columns kept, nothing shuffled. Of several
    blocks of the benchmark one is held at a time: what is clean of it is written, and only that meets the next one."""
    ship(docs.sparkSession)
    kept, before, blocks = docs, None, blocks_of(benchmark)
    items = next(blocks, None)
    while items is not None:
        sent = docs.sparkSession.sparkContext.broadcast(Pieces(items, rate, min_words))
        kept, items = kept.where(~_holder(sent)(F.col("text"))), next(blocks, None)
        if items is not None:
            kept = written(kept, "clean")
            sent.destroy()
            if before is not None:
                drop_written(before)
            before = kept
    return kept
