"""Removal of repeated byte strings: Burrows-Wheeler transforms of shards, merged by iterative interleave refinement."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop_written, mixed, ship, written

#: Bytes of the strings that count as repeated; bytes of a symbol of the transforms, and of the first look at a suffix.
#: LENGTH is FIRST and a whole number of symbols.
LENGTH, SYMBOL, FIRST = 100, 8, 4
#: Bytes of the grams that choose what can be repeated: every string of LENGTH bytes is told by the least of its grams.
GRAM = 50
#: A gram in more places than HOT tells too little: a string is then told by the STEP starts that it is one of and the
#: bytes that these have in common.
HOT, STEP = 20_000, 4
#: Bytes of texts in a part, of what is hashed at a time, of texts for each bucket of grams, of a shard (in contexts), and
#: of the contexts that are merged in one task (on average).
PART_BYTES, BLOCK, BUCKET_BYTES, SHARD_BYTES, TASK_BYTES = 4 << 20, 1 << 18, 16 << 20, 1 << 20, 4 << 20
_PLACE = np.uint64((1 << 20) - 1)
_ODD = 0x9E3779B97F4A7C15
_LAST = (1 << 63) - 1
SPANS = "row bigint, start bigint, end bigint"
EMPTY = hashlib.sha256(b"").hexdigest()


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd number, and of its inverse, modulo 2 to the 64."""
    with np.errstate(over="ignore"):
        table = [np.cumprod(np.r_[np.uint64(1), np.full(n, b, np.uint64)], dtype=np.uint64) for b in (_ODD, pow(_ODD, -1, 1 << 64))]
    return table[0], table[1]


_POWERS, _INVERSES = _power_table(BLOCK + LENGTH)


@dataclass
class Told:
    """Strings of LENGTH bytes of a block by what tells them: text, first and last start, the gram's place and hash."""

    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    at: np.ndarray
    gram: np.ndarray
    sums: np.ndarray

    def hashed(self, start: int, end: int) -> int:
        """A hash of the bytes from start to end, as a bigint."""
        with np.errstate(over="ignore"):
            own = mixed((self.sums[end : end + 1] - self.sums[start : start + 1]) * _INVERSES[start : start + 1] + np.uint64(end - start))
        return int(own.view(np.int64)[0])


def told(block: np.ndarray, sizes: np.ndarray) -> Told:
    """For the texts of a block (their bytes one behind the other): their strings of LENGTH bytes by the least hash among
    the grams in each, the first of equals. Which gram that is follows from the string alone, so equal strings agree."""
    n, none = len(block), np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((block.astype(np.uint64) + np.uint64(1)) * _POWERS[:n], out=sums[1:])
        if n < LENGTH:
            return Told(none, none, none, none, none, sums)
        hashes = mixed((sums[GRAM:] - sums[:-GRAM]) * _INVERSES[: n - GRAM + 1])
    least, width, grams = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), 1, LENGTH - GRAM + 1
    while width * 2 <= grams:
        least, width = np.minimum(least[:-width], least[width:]), width * 2
    if width < grams:
        least = np.minimum(least[: len(least) - (grams - width)], least[grams - width :])
    at = (least & _PLACE).astype(np.int64)
    number = np.repeat(np.arange(len(sizes)), sizes)[: len(at)]
    new = np.r_[True, (at[1:] != at[:-1]) | (number[1:] != number[:-1])]
    first = np.flatnonzero(new)
    text = number[first]
    last = np.minimum(np.r_[first[1:] - 1, len(at) - 1], np.cumsum(sizes)[text] - LENGTH)
    keep = first <= last
    first, last, text = first[keep], last[keep], text[keep]
    return Told(text, first, last, at[first], hashes[at[first]].view(np.int64), sums)


def blocks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]]:
    """The bytes of texts in blocks: bytes, sizes, and for each piece its text's number and where it starts there. A long
    text is cut into pieces that overlap by LENGTH - 1, so that each string is in one piece."""
    run: list[bytes] = []
    names: list[tuple[int, int]] = []
    size = 0
    for i, text in enumerate(texts):
        for start in range(0, max(1, len(text) - LENGTH + 1), BLOCK):
            piece = text[start : start + BLOCK + LENGTH - 1]
            if run and size + len(piece) > BLOCK:
                yield np.frombuffer(b"".join(run), np.uint8), np.array([len(r) for r in run]), names
                run, names, size = [], [], 0
            run.append(piece)
            names.append((i, start))
            size += len(piece)
    if run:
        yield np.frombuffer(b"".join(run), np.uint8), np.array([len(r) for r in run]), names


class Shard:
    """The Burrows-Wheeler transform of a collection of short texts over symbols of SYMBOL bytes.

    Rows are the suffixes of FIRST bytes or more in the order of their bytes (as far as LENGTH, in steps of FIRST).
    front is the symbol that a row begins with, and before[i] the row whose suffix is longer by one symbol, which is
    that row's front (-1: the text has none there): the last-to-first mapping. start and text say where a row is.
    """

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts) + bytes(SYMBOL), np.uint8)
        ends = np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(ends[-1])  # bytes from each place to the end of its text
        at = np.flatnonzero(left >= FIRST)
        row = np.full(len(data) + 2 * LENGTH, -1, np.int64)
        wide = np.zeros(len(data), np.uint64)
        for k in range(SYMBOL):
            wide[: len(data) - k] |= data[k:].astype(np.uint64) << np.uint64(8 * (SYMBOL - 1 - k))
        order = at[np.argsort(wide[at] >> np.uint64(8 * (SYMBOL - FIRST)), kind="stable")]
        key, rank, depth = wide[order] >> np.uint64(8 * (SYMBOL - FIRST)), row, FIRST
        head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        rank[order] = np.repeat(head, np.diff(np.r_[head, len(order)]))
        while depth < LENGTH:  # prefix doubling among rows that are still alike; a rank is the place of its first row
            mine = rank[order]
            same = mine[1:] == mine[:-1]
            tied = np.flatnonzero(np.r_[same, False] | np.r_[False, same])
            if not len(tied):
                break
            place = order[tied]
            behind = np.where(left[place] >= depth + FIRST, rank[place + depth], -1)
            key = (mine[tied] << 32) | (behind + 1)
            by = np.argsort(key, kind="stable")
            order[tied], key, group = place[by], key[by], mine[tied][by]
            new = np.r_[True, key[1:] != key[:-1]]
            at_first = np.where(np.r_[True, group[1:] != group[:-1]], group, tied)
            fresh = at_first[new]
            rank[order[tied]] = np.repeat(fresh, np.diff(np.r_[np.flatnonzero(new), len(key)]))
            depth *= 2
        row[order] = np.arange(len(order))
        number = np.repeat(np.arange(len(texts)), sizes)
        self.text, self.start = number[order], order - (ends - sizes)[number[order]]
        self.front, self.left = wide[order], left[order]
        before = np.where(self.start >= SYMBOL, row[order - SYMBOL], -1)
        self.before = before.astype(np.int64)


def repeated(shards: list[Shard]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The repeated intervals of the merged transform: for each shard the rows whose first LENGTH bytes are those of
    another row of any shard, and the number of the interval that each is in.

    The order of all shards' rows together is refined round by round and no suffix is sorted again. At first two rows
    are in one interval if they agree in FIRST bytes. A round goes through the intervals of all shards in their order and
    hands each row's interval to the row before it: by the front of that row, then by what was handed over, a shard's
    rows are in order already, so the shards' lists of intervals are merged and counted. After a round, intervals agree in
    SYMBOL bytes more; the round in which two neighbours part tells their common prefix, and a row that is alone in its
    interval has less than LENGTH in common with any other, as has every row before it, so both are passed over from then.
    """
    symbols = np.unique(np.concatenate([s.front[s.left >= SYMBOL][np.r_[True, np.diff(s.front[s.left >= SYMBOL]) > 0]] if (s.left >= SYMBOL).any() else np.empty(0, np.uint64) for s in shards]))
    fronts = [np.searchsorted(symbols, s.front) for s in shards]
    alive = [np.arange(len(s.front)) for s in shards]
    alive, interval = _merged(alive, [(s.front >> np.uint64(8 * (SYMBOL - FIRST))).astype(np.int64) for s in shards])
    for _ in range((LENGTH - FIRST) // SYMBOL):
        rows, keys = [], []
        for s, front, own, named in zip(shards, fronts, alive, interval, strict=True):
            before = s.before[own]
            handed = np.full(len(s.front), -1, np.int64)
            handed[before[before >= 0]] = named[before >= 0]
            rows.append(np.flatnonzero(handed >= 0))
            keys.append((front[rows[-1]] << 31) | handed[rows[-1]])
        alive, interval = _merged(rows, keys)
    return alive, interval


def _merged(rows: list[np.ndarray], keys: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of rows with their keys (ascending in each shard), those that share a key, and the rank of each key in all."""
    heads = [np.flatnonzero(np.r_[True, k[1:] != k[:-1]][: len(k)]) for k in keys]
    sizes = [np.diff(np.r_[h, len(k)]) for h, k in zip(heads, keys, strict=True)]
    both = np.concatenate([k[h] for h, k in zip(heads, keys, strict=True)])
    order = np.argsort(both, kind="stable")  # ascending runs, which this sort merges
    rank = np.empty(len(both), np.int64)
    rank[order] = np.cumsum(np.r_[0, both[order][1:] != both[order][:-1]][: len(both)])
    count = np.bincount(rank, np.concatenate(sizes)) if len(both) else np.empty(0)
    out_rows, out_named = [], []
    for own, size, named in zip(rows, sizes, np.split(rank, np.cumsum([len(h) for h in heads])[:-1]), strict=True):
        each = np.repeat(named, size)
        several = count[each] > 1 if len(each) else np.empty(0, bool)
        out_rows.append(own[several])
        out_named.append(each[several])
    return out_rows, out_named


def later(texts: list[bytes], shard_bytes: int = SHARD_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and start of every string of LENGTH bytes that an earlier text holds, or the same one before.
    The texts are in their order."""
    shards, bounds, size, begin = [], [], 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= shard_bytes or i == len(texts) - 1:
            shards.append(Shard(texts[begin : i + 1]))
            bounds.append(begin)
            begin, size = i + 1, 0
    if not shards:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rows, named = repeated(shards)
    text = np.concatenate([s.text[r] + b for s, r, b in zip(shards, rows, bounds, strict=True)])
    start, interval = np.concatenate([s.start[r] for s, r in zip(shards, rows, strict=True)]), np.concatenate(named)
    order = np.lexsort((start, text, interval))
    other = np.r_[False, np.diff(interval[order]) == 0][: len(order)]  # all but the first of each interval
    return text[order][other], start[order][other]


def joined_spans(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> pd.DataFrame:
    """Spans of rows as the fewest that cover the same."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    if not len(row):
        return pd.DataFrame({"row": row, "start": start, "end": end})
    head = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    base = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(row)]))
    reach = np.maximum.accumulate(end + base * (int(end.max()) + 1)) - base * (int(end.max()) + 1)
    new = np.r_[True, (row[1:] != row[:-1]) | (start[1:] > reach[:-1])]
    heads = np.flatnonzero(new)
    return pd.DataFrame({"row": row[heads], "start": start[heads], "end": reach[np.r_[heads[1:], len(row)] - 1]})


def _numbered(docs: DataFrame) -> DataFrame:
    """doc, row, part, data, n and sha of all documents: rows are numbered, and dealt into parts of about PART_BYTES."""

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, size, k = TaskContext.get().partitionId() << 32, 0, 0
        for pdf in batches:
            parts, rows = [], []
            for data in pdf["data"]:
                if k and (size + len(data) > PART_BYTES or k == 1 << 12):
                    part, size, k = part + (1 << 12), 0, 0
                parts.append(part)
                rows.append(part + k)
                size, k = size + len(data), k + 1
            sha = [hashlib.sha256(d).hexdigest() for d in pdf["data"]]
            yield pdf.assign(part=np.array(parts, np.int64), row=np.array(rows, np.int64), n=[len(d) for d in pdf["data"]], sha=sha)

    id_ = F.col("doc_id").cast("long")
    raw = docs.select(id_.alias("doc_id"), F.coalesce(id_, F.lit(_LAST)).alias("doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("data"))
    return raw.mapInPandas(number, "doc_id bigint, doc bigint, data binary, part bigint, row bigint, n bigint, sha string")


def _repeated_grams(texts: DataFrame, n_buckets: int) -> DataFrame:
    """For each part (part, grams, hot): which of the grams that tell its strings are in several places, and in more than
    HOT; both as int64 bytes, in several rows. Counts go by bucket, a gram once for each part."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part, own in pdf.groupby("part", sort=False):
                found = [told(b, sizes).gram for b, sizes, _ in blocks(own["data"].tolist())]
                grams, counts = np.unique(np.concatenate(found), return_counts=True)
                bucket = np.mod(grams, n_buckets)
                order = np.argsort(bucket, kind="stable")
                cut = np.flatnonzero(np.diff(bucket[order])) + 1
                each = list(zip(np.split(grams[order], cut), np.split(counts[order].astype(np.uint32), cut)))
                if len(grams):
                    yield pd.DataFrame({"bucket": bucket[order][np.r_[0, cut]], "part": part, "grams": [g.tobytes() for g, _ in each], "counts": [c.tobytes() for _, c in each]})

    def several(pdf: pd.DataFrame) -> pd.DataFrame:
        each = [np.frombuffer(g, np.int64) for g in pdf["grams"]]
        grams, inverse = np.unique(np.concatenate(each), return_inverse=True)
        total = np.bincount(inverse, np.concatenate([np.frombuffer(c, np.uint32) for c in pdf["counts"]]))[inverse]
        totals = np.split(total, np.cumsum([len(g) for g in each])[:-1])
        out = pd.DataFrame({"part": pdf["part"], "grams": [g[t > 1].tobytes() for g, t in zip(each, totals)], "hot": [g[t > HOT].tobytes() for g, t in zip(each, totals)]})
        return out[out["grams"].str.len() > 0]

    counted = texts.select("part", "data").mapInPandas(count, "bucket bigint, part bigint, grams binary, counts binary")
    return counted.groupBy("bucket").applyInPandas(several, "part bigint, grams binary, hot binary")


def _contexts(texts: DataFrame, grams: DataFrame) -> DataFrame:
    """What may be repeated, as gram, doc, row, start and data: the bytes of all strings that a gram of several places
    tells. Of equal ones in a part the first stays; of the others all bytes are repeated: spans, with end and no data."""

    def cut(own: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        columns = {"gram": [], "doc": [], "row": [], "start": [], "end": [], "data": []}
        asked, hot = (np.unique(np.concatenate([np.frombuffer(b, np.int64) for b in wanted[c]] or [np.empty(0, np.int64)])) for c in ("grams", "hot"))
        own = own.sort_values(["doc", "row"])
        docs, rows, texts = own["doc"].tolist(), own["row"].tolist(), own["data"].tolist()
        seen: set[bytes] = set()

        def add(gram: int, number: int, start: int, data: bytes) -> None:
            repeat = data in seen
            seen.add(data)
            for c, v in zip(columns.values(), (gram, docs[number], rows[number], start, start + len(data), None if repeat else data), strict=True):
                c.append(v)

        for block, sizes, names in blocks(texts) if len(asked) else ():
            t, begins = told(block, sizes), np.cumsum(sizes) - sizes
            keep = np.flatnonzero(np.isin(t.gram, asked))
            many = np.isin(t.gram[keep], hot)
            data = block.tobytes()
            for i, is_hot in zip(keep.tolist(), many.tolist()):
                text, first, last, at, gram = int(t.text[i]), int(t.first[i]), int(t.last[i]), int(t.at[i]), int(t.gram[i])
                number, offset = names[text]
                move = offset - int(begins[text])
                while first <= last:
                    end = last
                    if is_hot:  # starts that are as far before the gram, in steps
                        step = (at - first) // STEP
                        end = min(last, at - step * STEP)
                        common = at - step * STEP
                        gram = t.hashed(common, common - STEP + 1 + LENGTH)
                    add(gram, number, first + move, data[first : end + LENGTH])
                    first = end + 1
        return pd.DataFrame(columns).astype({"gram": np.int64, "doc": np.int64, "row": np.int64, "start": np.int64, "end": np.int64})

    schema = "gram bigint, doc bigint, row bigint, start bigint, end bigint, data binary"
    return texts.select("part", "doc", "row", "data").groupBy("part").cogroup(grams.groupBy("part")).applyInPandas(cut, schema)


def _later_spans(pdf: pd.DataFrame) -> pd.DataFrame:
    """The spans of one bucket's contexts that are covered by strings that start earlier."""
    pdf = pdf.sort_values(["doc", "row", "start"])
    copies = pdf["data"].duplicated().to_numpy()
    row, start, end = (pdf[c].to_numpy(np.int64) for c in ("row", "start", "end"))
    several = (~copies) & pdf["gram"].where(~copies).duplicated(keep=False).to_numpy()
    at = np.flatnonzero(several)
    text, where = later(pdf["data"].iloc[at].tolist()) if len(at) else (at, at)
    begin = start[at[text]] + where
    return joined_spans(np.r_[row[copies], row[at[text]]], np.r_[start[copies], begin], np.r_[end[copies], begin + LENGTH])


def repeated_spans(texts: DataFrame, n_bytes: int) -> DataFrame:
    """row, start and end of spans of texts (part, doc, row, data; no two of them equal) that are covered by strings of
    LENGTH bytes which also start earlier."""
    grams = written(_repeated_grams(texts, max(1, n_bytes // BUCKET_BYTES)), "grams")
    found = written(_contexts(texts, grams), "contexts")
    drop_written(grams)
    size = found.agg(F.sum(F.length("data"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("gram"), F.lit(size // TASK_BYTES + 1))
    merged = found.where(F.col("data").isNotNull()).groupBy(bucket.alias("bucket")).applyInPandas(_later_spans, SPANS)
    return merged.union(found.where(F.col("data").isNull()).select("row", "start", "end"))


def drop_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that stay) and spans of every document (doc_id,
    text): each byte goes that is covered by a string of LENGTH bytes which also starts earlier, in a document of smaller
    doc_id or before in the same one.

    A text that is another's copy goes whole, so only different texts are searched. A string of LENGTH bytes is told by
    the least of the hashes of its grams; only strings whose gram is in several places can be repeated, and they are
    gathered by gram: equal ones meet. There, shards of contexts get a Burrows-Wheeler transform each, and these are
    merged by interleave refinement (repeated()). Bytes decide throughout, hashes only bring them together. A gram in more
    than HOT places is replaced by LENGTH - STEP + 1 bytes, so that what gathers under one is contexts that differ in
    STEP - 1 bytes at an end, however common a passage is.

    Defined cases: a null text is empty and, like any under LENGTH bytes, keeps all; rows that repeat a doc_id are
    documents of their own, in no stated order; null ids come last; other columns are ignored; no rows give no rows.
    """
    ship(docs.sparkSession)
    whole = written(_numbered(docs), "numbered")
    slim = whole.select("row", "doc", "sha", "n").where(F.col("n") >= LENGTH)
    first = slim.groupBy("sha").agg(F.min(F.struct("doc", "row")).alias("f"), F.count("*").alias("k")).where("k > 1").select("sha", F.col("f.row").alias("first"))
    copies = written(slim.join(first, "sha").where("row != first").select("row"), "copies")
    texts = whole.where(F.col("n") >= LENGTH).join(copies, "row", "left_anti").select("part", "doc", "row", "data")
    spans = written(repeated_spans(texts, whole.agg(F.sum("n")).first()[0] or 0), "spans")
    each = spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    gone = copies.withColumn("copy", F.lit(True))

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for data, n, sha, found, copy in zip(pdf["data"], pdf["n"], pdf["sha"], pdf["spans"], pdf["copy"]):
                if copy is True or copy is np.True_:
                    rows.append((n, n, 1, EMPTY, b"", [{"start": 0, "end": n}]))
                elif found is None or not len(found):
                    rows.append((n, 0, 0, sha, data, []))
                else:
                    s, e = (np.array([x[c] for x in found], np.int64) for c in ("start", "end"))
                    own = joined_spans(np.zeros(len(s), np.int64), s, e)
                    cut, at = [], 0
                    for a, b in zip(own["start"], own["end"]):
                        cut.append(data[at:a])
                        at = b
                    left = b"".join([*cut, data[at:]])
                    rows.append((n, n - len(left), len(own), hashlib.sha256(left).hexdigest(), left, own[["start", "end"]].to_dict("records")))
            out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])
            out.insert(0, "doc_id", pdf["doc_id"].astype("Int64").to_numpy())
            yield out

    both = whole.select("row", "doc_id", "n", "sha", "data").join(each, "row", "left").join(gone, "row", "left")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, spans array<struct<start:bigint,end:bigint>>"
    return both.select("doc_id", "n", "sha", "data", "spans", F.coalesce("copy", F.lit(False)).alias("copy")).mapInPandas(keep, schema)
