"""What several operators share: tables in the cluster's shared folder, and vectorised word hashing."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that are hashed in one go; a longer text is hashed in slices of this size, but no word is cut.
BLOCK_BYTES = 1 << 20
#: Rows of a batch of texts.
BATCH_ROWS = 1024
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_POSITIONS = 1024
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(_POSITIONS, 0xD6E8FEB86659FD93, dtype=np.uint64), dtype=np.uint64)
_CLASS = np.full(256, 2, dtype=np.uint8)  # punctuation and symbols
_CLASS[[9, 10, 11, 12, 13, 32, *range(9), *range(14, 32)]] = 0
_CLASS[[*range(48, 58), *range(97, 123), *range(128, 256)]] = 1  # digits, letters, bytes of non-ASCII characters

#: Marks beyond ASCII, by the first bytes of their UTF-8: U+0080-00BF, U+2000-207F, U+3000-303F.
_MARKS = ((0xC2, (), 2), (0xE2, (0x80, 0x81), 3), (0xE3, (0x80,), 3))

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives this package to the executors, as spark-submit --py-files would; once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]  # the archive is the driver's own file; Spark serves it to executors
    if top.suffix != ".zip" and top.is_dir():
        folder = tempfile.mkdtemp(prefix="marketlake-package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.addPyFile(shutil.make_archive(os.path.join(folder, top.name), "zip", top.parent, top.name))
    _SHIPPED.add(sc.applicationId)


def small_batches(spark: SparkSession) -> None:
    """From now on Python tasks get texts in batches of BATCH_ROWS rows at most: batches are sized by rows, and Spark's own
    number of rows is many MB of texts in the executor and in its Python workers, twice."""
    if int(spark.conf.get(_ARROW_ROWS)) > BATCH_ROWS:
        spark.conf.set(_ARROW_ROWS, str(BATCH_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a local master (tests) gets
    a temporary one; on a cluster it would be another folder on each machine, so that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="marketlake-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read back: it is computed once, its lineage ends there, and it
    outlives any executor. The table goes when the application ends."""
    path = f"{shared_folder(df.sparkSession)}/marketlake/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    fs, p = _hadoop(df.sparkSession, path)
    fs.deleteOnExit(p)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Deletes the files of a table that written() made and that nothing reads any more."""
    for path in {f.rpartition("/")[0] for f in df.inputFiles() if "/marketlake/" in f}:
        fs, p = _hadoop(df.sparkSession, path)
        fs.delete(p, True)


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop's objects."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _slices(data: bytes) -> Iterator[bytes]:
    """data in slices of about BLOCK_BYTES, cut behind white space: a longer word makes a longer slice."""
    at = 0
    while len(data) - at > BLOCK_BYTES:
        end = at + BLOCK_BYTES
        cut = max(data.rfind(b" ", at, end), data.rfind(b"\n", at, end))
        if cut < 0:
            ahead = [p for p in (data.find(b" ", end), data.find(b"\n", end)) if p >= 0]
            cut = min(ahead, default=len(data) - 1)
        yield data[at : cut + 1]
        at = cut + 1
    yield data[at:]


def _hashes(data: bytes, words_only: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of each token in data: its hash and where it starts."""
    raw = np.frombuffer(data, dtype=np.uint8)
    kind = _CLASS[raw]
    for lead, seconds, size in _MARKS:
        at = np.flatnonzero(raw[: len(raw) - size + 1] == lead)
        at = at[np.isin(raw[at + 1], seconds)] if seconds else at
        for k in range(size if len(at) else 0):
            kind[at + k] = 2
    if words_only:
        kind = np.where(kind == 1, kind, 0).astype(np.uint8)
    first = np.empty(len(raw), dtype=bool)
    first[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    starts = np.flatnonzero(first & (kind != 0))
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts
    lengths = np.diff(starts, append=len(raw))
    within = np.arange(starts[0], len(raw)) - np.repeat(starts, lengths)
    with np.errstate(over="ignore"):
        terms = (raw[starts[0] :].astype(np.uint64) + np.uint64(1)) * _POWERS[within % _POSITIONS]
        terms[kind[starts[0] :] == 0] = 0
        sums = np.add.reduceat(terms, starts - starts[0])
        sums ^= sums >> np.uint64(29)
        sums *= _MULTIPLIER
    return sums, starts


def token_hashes(texts: list[str | None], words_only: bool) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Yields (number of the first text, hashes of the tokens of each text) for one run of texts after another.

    A text is lower-cased. A token is a longest run of letters and digits (ASCII's, and all of Unicode but the marks in
    _MARKS), or, unless words_only, of marks. Null and empty texts have no tokens. Short texts are hashed together, a
    text over BLOCK_BYTES in slices.
    """
    run: list[bytes] = []
    begin = size = 0
    for i, text in enumerate(texts):
        data = (text or "").lower().encode("utf-8", "replace")
        if run and size + len(data) > BLOCK_BYTES:
            yield begin, _run(run, words_only)
            run, begin, size = [], i, 0
        run.append(data)
        size += len(data) + 1
    if run:
        yield begin, _run(run, words_only)


def _run(run: list[bytes], words_only: bool) -> list[np.ndarray]:
    if len(run) == 1:
        return [np.concatenate([_hashes(s, words_only)[0] for s in _slices(run[0])])]
    found, starts = _hashes(b"\n".join(run), words_only)
    ends = np.cumsum([len(d) + 1 for d in run])
    return np.split(found, np.searchsorted(starts, ends[:-1]))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads uint64 hashes over all their bits."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(32))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(count, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + count]
    return mixed(out)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not have: name with underscores before it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def largest(idx: np.ndarray, val: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n features with the largest values (ties: the first), in their order."""
    if len(idx) <= n:
        return idx, val
    keep = np.sort(np.argsort(-val, kind="stable")[:n])
    return idx[keep], val[keep]
