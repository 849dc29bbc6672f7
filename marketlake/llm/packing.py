"""Packing documents into sequences: first-fit decreasing over a tournament tree of free space, in random groups."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship

SEQUENCE = 4096
TOKENIZER = "word_bpe_49k.json"
END = 2
#: Documents in a group, on average; with their pieces.
GROUP_DOCS = 8192
#: Words whose ids a Python worker remembers, and the longest of them.
MEMORY_WORDS, MEMORY_LENGTH = 1_000_000, 48
#: Texts that are encoded together.
BATCH = 256
_SEPARATORS = re.compile(r"[\x1c-\x1f]")
#: Characters that combine with the one before (ranges that hold them all) or become one that does in lower case; two
#: marks side by side; letters with marks behind them.
_COMBINING = re.compile("[\u0130\u0300-\u036f\u0483-\u0489\u0591-\u0dff\u0e31-\u0eff\u0f18-\u0fff\u1037-\u109f\u135d-\u135f\u1700-\u1cff\u1dc0-\u1dff\u20d0-\u20ff\u302a-\u309a\ua66f-\uabff\ufb1e\ufe20-\ufe2f\U00010000-\U0010ffff]")
_MARKS = re.compile(r"(?:[^\w\s]|_){2}")
_TAIL = re.compile(r"([^\W\d_]+)([!-/:-@\[-`{-~]+)")
_SPACE = re.compile(r"[^\S\x1c-\x1f]+")
#: What the short cuts of Encoder rely on; a tokenizer with other settings encodes whole texts.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORDS = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers.

    The tokenizer's ids of a text are those of its stretches between white space, one after another: white space ends
    every word and is dropped. So a stretch is encoded once and remembered. Of letters with marks behind them, letters
    and marks are words of their own; and ASCII capitals are lower-cased anyway. All this is so for a tokenizer of
    _NORMALIZERS and _WORDS whose words end in "</w>"; any other encodes each text as it is.
    """

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)  # ids that end a word
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        settings = json.loads(self.tokenizer.to_str())
        words = (settings["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        spread = [w for w in words[1:] if w.get("type") != "ByteLevel" or w.get("use_regex") or w.get("add_prefix_space")]
        normal = (settings["normalizer"] or {}).get("normalizers")
        self.by_words = normal == _NORMALIZERS and words[0] == _WORDS and not spread and settings["model"].get("end_of_word_suffix") == "</w>"

    def _encode(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word: those of letters only as one text, cut where words end, others one by one."""
        letters = [w for w in words if w.isalpha()]
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(letters)], add_special_tokens=False)[0].ids, dtype="<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1 if len(ids) else np.empty(0, dtype=np.int64)
        out: dict[str, bytes] = {}
        if len(cuts) == len(letters) and (not len(cuts) or cuts[-1] == len(ids)):
            data, at = ids.tobytes(), 0
            for w, end in zip(letters, (cuts * 4).tolist()):
                out[w] = data[at:end]
                at = end
        rest = [w for w in words if w not in out]
        out.update((w, np.array(e.ids, dtype="<u4").tobytes()) for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)))
        return out

    def _learn(self, fresh: set[str]) -> dict[str, bytes]:
        """Ids of stretches that are not known, and of the letters and marks in them."""
        known, split = self.known, {}
        for w in fresh:
            if not w.isalpha() and (m := _TAIL.fullmatch(w)) and m[1].isalpha() and not _COMBINING.search(w):
                split[w] = m.groups()
        needed = fresh.difference(split).union(*split.values()).difference(known)
        out = self._encode(sorted(needed))
        for w, (letters, marks) in split.items():
            out[w] = (out.get(letters) or known[letters]) + (out.get(marks) or known[marks])
        return out

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text of a batch; new words are learned first, and forgotten all at once when they are too many."""
        if not self.by_words:
            return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
        each = [_stretches(t or "") for t in texts]
        known = self.known
        if len(known) > MEMORY_WORDS:
            known.clear()
        known.update(self._learn(set().union(*each).difference(known)))
        out = [b"".join(map(known.__getitem__, words)) for words in each]
        for w in [w for words in each for w in words if len(w) > MEMORY_LENGTH]:
            known.pop(w, None)
        return out


def _stretches(text: str) -> list[str]:
    """What stands between white space, of which the tokenizer does not count \\x1c to \\x1f.

    Where nothing can combine with an ASCII letter, those are lower-cased here; where no two marks stand side by side,
    stops and commas that end a stretch are split off. Both make fewer different stretches with the same ids.
    """
    if _SEPARATORS.search(text):
        return [w for w in _SPACE.split(text) if w]
    if text.isascii() or not _COMBINING.search(text):
        text = text.encode("utf-8", "replace").lower().decode()
        if not _MARKS.search(text):
            text = text.replace(". ", " . ").replace(", ", " , ").replace(".\n", " .\n")
    return text.split()


def encoder(name: str) -> Encoder:
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(name)
    return _ENCODERS[name]


class Tournament:
    """Bins in the order of their opening; a complete binary tree whose nodes hold the largest free space below."""

    def __init__(self, bins: int, space: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.best = [space] * (2 * self.leaves)

    def take(self, need: int) -> int:
        """The first bin with so much free space, which is taken; there must be one."""
        at = 1
        while at < self.leaves:
            at *= 2
            if self.best[at] < need:
                at += 1
        bin_ = at - self.leaves
        self.best[at] -= need
        while at > 1:
            at //= 2
            left, right = self.best[2 * at], self.best[2 * at + 1]
            self.best[at] = left if left >= right else right
        return bin_


def first_fit_decreasing(lengths: list[int], space: int) -> list[int]:
    """The bin of each length, longest first; ties in their given order."""
    tree, out = Tournament(max(1, len(lengths)), space), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        out[i] = tree.take(lengths[i])
    return out


def pieces_of(docs: DataFrame, space: int, tokenizer: str) -> DataFrame:
    """doc_id, start, length, ids_crc32 and doc_tokens of each piece: a document is cut behind every `space` ids. The
    salt tells documents apart, by their tokens and, of equal ones in a task, by number."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, end = encoder(tokenizer), END.to_bytes(4, "little")
        seen: Counter[tuple] = Counter()
        for pdf in batches:
            for at in range(0, len(pdf), BATCH):
                part = pdf.iloc[at : at + BATCH]
                rows = []
                for doc, ids in zip(part["doc_id"], enc.ids([t if isinstance(t, str) else None for t in part["text"]])):
                    ids += end
                    total, crc = len(ids) // 4, zlib.crc32(ids)
                    equal = hash((0 if pd.isna(doc) else int(doc), crc, total))
                    salt = crc << 31 | seen[equal] % (1 << 31)  # equal rows have different ones, whichever comes first
                    seen[equal] += 1
                    rows += [(doc, k, min(space, total - k), zlib.crc32(ids[4 * k : 4 * (k + space)]), total, salt) for k in range(0, total, space)]
                yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt"]).astype({"doc_id": "Int64"})

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInPandas(cut, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, salt bigint")


def pack(docs: DataFrame, space: int = SEQUENCE, tokenizer: str = TOKENIZER, group_docs: int = GROUP_DOCS) -> DataFrame:
    """Packs every document of docs (doc_id, text) into sequences of at most `space` tokens.

    Returns per piece doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset; other columns are ignored.
    A document is its tokens and an end token. Documents over `space` tokens are cut into full pieces and a rest. A
    hash of the piece, which differs for equal rows too, deals pieces into groups of about group_docs; each group is packed by itself:
    longest piece first, each into the first sequence with room. Only lengths and checksums are shuffled, never ids or
    texts. sequence_id is the group times 2^32 plus the sequence's number in it.

    Defined cases: a null or empty text is the end token alone; repeated rows are documents of their own; a null
    doc_id is dealt by its tokens; ties in length are broken by doc_id and start; an empty table gives no rows.
    """
    groups = max(1, round(docs.count() / group_docs))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    dealt = pieces_of(docs, space, tokenizer).withColumn("group", F.pmod(F.xxhash64("doc_id", "salt", "start", F.lit("packing")), F.lit(groups)))

    def fill(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "start", "ids_crc32"], ignore_index=True)
        bins = first_fit_decreasing(pdf["length"].tolist(), space)
        pdf["sequence_id"] = [(int(key[0]) << 32) + b for b in bins]
        pdf["offset"] = pdf.groupby("sequence_id")["length"].cumsum() - pdf["length"]
        return pdf[names]

    return dealt.groupBy("group").applyInPandas(fill, ", ".join(f"{n} bigint" for n in names))
