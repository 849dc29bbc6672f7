"""Secret scanning with a trigram inverted index."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce
from re import _parser as parser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .shared import ship, small_batches

#: Alternatives that a part of a regex may have and still be spelled out for its trigrams.
SPELLED = 64
#: Bytes of the texts of a shard, which is cut behind the text that reaches them, and of what is indexed in one go.
SHARD_BYTES, SLICE_BYTES = 4 << 20, 1 << 20
#: ASCII letters that characters beyond ASCII match too where case is ignored (dotless and dotted i, the Kelvin sign, long s).
FOLDED = frozenset("iks")


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its regex, and how long a group of the match has to be."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The contract's kinds, in its order.
BASE = (
    Rule("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{16,}"),
)
#: Further well-known forms; their spans come besides those of BASE.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_bot", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
#: A Boolean query in disjunctive form: one of these sets of trigrams must be there in full. None: any text can match.
Query = frozenset[frozenset[str]] | None


def trigram_query(pattern: str) -> Query:
    """The trigrams that any match of the regex must hold, ASCII letters in lower case; others are not indexed.

    Runs of the regex with few spellings are spelled out (alternatives, options, small classes); each run demands one
    of its spellings, each spelling all its trigrams; the run with the longest shortest spelling is taken. A regex
    without such a run of three characters or more has no query. Letters of FOLDED end a run where the regex ignores case
    beyond ASCII.
    """
    runs: list[set[str]] = []
    parsed = parser.parse(pattern)
    if (rest := _spell(parsed, runs, parsed.state.flags)) is not None:
        runs.append(rest)
    best = max(runs, key=lambda r: min(map(len, r)), default={""})
    if min(map(len, best)) < 3:
        return None
    sets = {frozenset(g for i in range(len(s) - 2) if (g := s[i : i + 3]).isascii()) for s in best}
    if frozenset() in sets:
        return None
    return frozenset(s for s in sets if not any(o < s for o in sets))


def _lower(char: int) -> str:
    return chr(char).lower() if char < 128 else chr(char)


def _spell(nodes, runs: list[set[str]], flags: int) -> set[str] | None:
    """All spellings of a sequence of regex nodes, or None if they are too many; then its runs go to runs. flags are
    those of re that hold here."""
    now: set[str] | None = {""}
    whole = True
    folds = flags & re.IGNORECASE and not flags & re.ASCII
    for op, arg in nodes:
        name = str(op)
        if name == "LITERAL":
            here = {_lower(arg)}
        elif name == "SUBPATTERN":
            here = _spell(arg[3], runs, (flags | arg[1]) & ~arg[2])
        elif name == "BRANCH":
            each = [_spell(x, [], flags) for x in arg[1]]
            here = None if any(x is None for x in each) else set().union(*each)
        elif name == "IN":
            chars = [_lower(x) for k, x in arg if str(k) == "LITERAL"]
            here = set(chars) if len(chars) == len(arg) <= 8 else None
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] == 0 and arg[1] == 1:
            here = _spell(arg[2], [], flags)
            here = None if here is None else here | {""}
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            here = {""}
        else:
            here = None
        if folds and name in ("LITERAL", "IN") and here is not None and here & FOLDED:
            here = None
        joined = None if here is None else {a + b for a in now for b in here}
        if joined is None or len(joined) > SPELLED:
            runs.append(now)
            now, whole = here if here is not None else {""}, False
        else:
            now = joined
    if whole:
        return now
    runs.append(now)
    return None


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@cache
def _asked(trigrams: frozenset[str]) -> tuple[np.ndarray, dict[int, str]]:
    """Which of all numbers of three bytes are given trigrams (made once in a task), and which number is which."""
    wanted = {int.from_bytes(g.encode(), "big"): g for g in trigrams if g.isascii()}
    asked = np.zeros(1 << 24, dtype=bool)
    asked[list(wanted)] = True
    return asked, wanted


class ShardIndex:
    """The inverted index of one shard of texts: for each of the given trigrams the sorted numbers of the texts it is in.

    It is made in one pass over the trigrams of all texts (of their bytes, ASCII letters in lower case), in slices that
    overlap by two bytes, so that a very long text takes no more memory than itself; trigrams that no rule asks for have
    no postings.
    """

    def __init__(self, texts: list[str], trigrams: set[str], slice_bytes: int = SLICE_BYTES):
        self.size = len(texts)
        asked, wanted = _asked(frozenset(trigrams))
        data = [t.encode("utf-8", "replace") for t in texts]
        ends = np.cumsum([len(d) + 1 for d in data]) if data else np.empty(0, dtype=np.int64)
        raw = np.frombuffer(b"\0".join(data), dtype=np.uint8)
        parts = [np.empty(0, dtype=np.int64)]
        for begin in range(0, len(raw) - 2, slice_bytes):
            low = _LOWER[raw[begin : begin + slice_bytes + 2]].astype(np.uint32)
            codes = low[:-2] << 16 | low[1:-1] << 8 | low[2:]
            at = np.flatnonzero(asked[codes])
            # of a trigram and a text one posting; a zero byte between texts is in no trigram of a rule
            parts.append(np.unique(codes[at].astype(np.int64) << 32 | np.searchsorted(ends, at + begin, side="right")))
        keys = np.unique(np.concatenate(parts))
        found, begins = np.unique(keys >> 32, return_index=True)
        lists = np.split(keys & 0xFFFFFFFF, begins[1:]) if len(found) else []
        self.postings = dict.fromkeys(trigrams, np.empty(0, dtype=np.int64)) | {wanted[c]: p for c, p in zip(found.tolist(), lists)}

    def candidates(self, query: Query) -> np.ndarray:
        """Numbers of the texts that can match: postings are intersected in a set, the sets' results united."""
        if query is None:
            return np.arange(self.size)
        both = lambda a, b: np.intersect1d(a, b, assume_unique=True)
        return reduce(np.union1d, (reduce(both, (self.postings[g] for g in sorted(s))) for s in query))


def spans_of(text: str, rule: Rule, regex: re.Pattern) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, in code points, without those whose group is too short."""
    return [m.span() for m in regex.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def shards(sizes: list[int], rows: int, size: int) -> Iterator[tuple[int, int]]:
    """Cuts texts of these sizes into runs (first, number) of at most so many rows, each over by its first text that makes
    it reach size."""
    first = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= size or i + 1 - first == rows:
            yield first, i + 1 - first
            first, total = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes) - first


def scan_secrets(docs: DataFrame, base: tuple[Rule, ...] = BASE, more: tuple[Rule, ...] = MORE, shard_rows: int = 2048, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Finds secrets in the whole text of each document.

    Each rule's regex gives a Boolean trigram query. Spark deals the documents out; each task indexes its texts in
    shards of shard_rows or shard_bytes, whichever is reached first, intersects the postings for each rule and runs the
    regex on the candidates only. A rule without mandatory trigrams (hex) is run on every text. Index and texts stay in
    the task: nothing is shuffled. A text of any length is scanned whole; a very long one ends its shard.

    Returns doc_id, n_<kind> for each base rule, base_sha256 (SHA-256 of the base spans "kind:start:end", ordered by
    start and rule, joined by commas) and spans (all spans, joined likewise), one row per row of docs; other columns
    are not returned. A null text counts as empty (no spans). Repeated rows are each scanned; doc_id may be null.
    """
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)
    rules = (*base, *more)
    queries = [trigram_query(r.pattern) for r in rules]
    names = [f"n_{r.kind}" for r in base]
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in names), ("base_sha256", pa.string()), ("spans", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        regexes = [re.compile(r.pattern) for r in rules]
        trigrams = {g for q in queries if q for s in q for g in s}
        for whole in batches:
            sizes = pc.fill_null(pc.binary_length(whole.column(1)), 0).to_pylist()
            for at, rows in shards(sizes, shard_rows, shard_bytes):
                batch = whole.slice(at, rows)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                index = ShardIndex(texts, trigrams)
                found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
                for k, (rule, query, regex) in enumerate(zip(rules, queries, regexes)):
                    for i in index.candidates(query):
                        found[i] += [(start, k, end) for start, end in spans_of(texts[i], rule, regex)]
                told = [sorted(f) for f in found]
                shown = lambda f: ",".join(f"{rules[k].kind}:{s}:{e}" for s, k, e in f)
                first = [[x for x in f if x[1] < len(base)] for f in told]
                counts = [pa.array([sum(x[1] == k for x in f) for f in told], pa.int64()) for k in range(len(base))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(pa.int64()), *counts, pa.array([hashlib.sha256(shown(f).encode()).hexdigest() for f in first]), pa.array([shown(f) for f in told])], schema=schema
                )

    fields = ", ".join(["doc_id bigint", *(f"{n} bigint" for n in names), "base_sha256 string", "spans string"])
    return docs.select("doc_id", "text").mapInArrow(scan, fields)
