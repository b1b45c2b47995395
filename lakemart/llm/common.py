"""Shared pieces: staged tables, word hashing, and the fold that splits labelled rows."""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import remove_path, scratch_path, write_table

#: ASCII white space, as in ``[\x20\x09-\x0D]``.
WHITE_SPACE = bytes([0x20, *range(0x09, 0x0E)])
#: Texts are hashed in pieces of about this many bytes, cut between words; what a worker keeps for it
#: is 64 times as large.
CHUNK_BYTES = 1 << 16
_ODD = 0x9E3779B97F4A7C15
_U64 = np.uint64


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation, and
    several consumers share one evaluation.
    """
    return write_table(df, scratch_path(df.sparkSession, name))


def discard(staged: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    for folder in {os.path.dirname(file) for file in staged.inputFiles()}:
        remove_path(staged.sparkSession, folder)


#: Whole texts go to Python in batches of at most so many rows and bytes, unless the session has
#: limits of its own: a task then holds a few batches, whatever the length of the texts.
BATCH_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
                "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m")}


def reach_workers(spark: SparkSession) -> None:
    """Prepare a session for Python in tasks: the search path of workers, and batch limits.

    A cluster has this package installed, or sent by ``--py-files``; local workers may have
    been started in another folder, and get its place.
    """
    for key, (default, limit) in BATCH_LIMITS.items():
        if spark.conf.get(key) == default:
            spark.conf.set(key, limit)
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


#: Arrow allocates by malloc, which has one pool, maps blocks of 256 KB and more by themselves, and
#: gives back what is free at the end of its heap from 1 MB on.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1",
                 "MALLOC_MMAP_THRESHOLD_": str(1 << 18), "MALLOC_TRIM_THRESHOLD_": str(1 << 20)}


def spare_workers(spark: SparkSession) -> None:
    """Workers that start from now on give back the memory of a batch when it is done.

    They outlive the step that they were started for: what one step's batches took is not there
    for the next step's JVM otherwise.  Variables that the session has set stay.
    """
    env = spark.sparkContext.environment
    for key, value in WORKER_MEMORY.items():
        env.setdefault(key, value)


def map_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``mapInArrow`` whose workers can import this package."""
    reach_workers(df.sparkSession)
    return df.mapInArrow(fn, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id_col: str | Column) -> Column:
    """The held-out fold: crc32 of the id's decimal text, modulo 5, is 0."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


_BYTE = mix(np.arange(1, 257, dtype=_U64) * _U64(_ODD))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64, at least ``n`` of each."""
    if not _POWERS or _POWERS[0].size < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        _POWERS[:] = []
        for base in (_ODD, pow(_ODD, -1, 1 << 64)):
            p = np.full(size, base, _U64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS[0], _POWERS[1]


def separators(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SPACES = separators(WHITE_SPACE)


def word_hashes(raw: bytes, is_space: np.ndarray = _SPACES) -> np.ndarray:
    """One 64-bit hash per word of ``raw``, in order; words are runs of non-separators.

    A prefix sum of weighted bytes gives each word's polynomial hash without a
    Python step per word.
    """
    a = np.frombuffer(raw, np.uint8)
    if a.size > 2 * CHUNK_BYTES:
        gaps = np.flatnonzero(is_space[a])
        cuts = gaps[np.unique(np.minimum(np.searchsorted(gaps, np.arange(
            CHUNK_BYTES, a.size, CHUNK_BYTES)), gaps.size - 1))] if gaps.size else gaps
        ends = np.unique(np.concatenate(([0], cuts, [a.size])))
        parts = [_hash_piece(a[i:j], is_space) for i, j in zip(ends[:-1], ends[1:], strict=True)]
        return np.concatenate(parts) if parts else np.empty(0, _U64)
    return _hash_piece(a, is_space)


def _hash_piece(a: np.ndarray, is_space: np.ndarray) -> np.ndarray:
    n = a.size
    if n == 0:
        return np.empty(0, _U64)
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = ~is_space[a]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _powers(n + 1)
    total = np.zeros(n + 1, _U64)
    np.cumsum(_BYTE[a] * power[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def window_hashes(words: np.ndarray, offsets: list[int]) -> np.ndarray:
    """For every position the hash of the words at ``offsets`` after it (an order-sensitive sum)."""
    span = offsets[-1] + 1
    n = words.size - span + 1
    if n <= 0:
        return np.empty(0, _U64)
    acc = np.zeros(n, _U64)
    for o in offsets:
        acc = acc * _U64(0xD6E8FEB86659FD93) + words[o:o + n]
    return mix(acc)


def shingle_set(raw: bytes | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles of a text.

    A-Z are lower-cased; a text with fewer words is one shingle, its whole
    sequence; a text without words, or null, has none.
    """
    if not raw:
        return np.empty(0, _U64)
    w = word_hashes(raw.lower())
    if w.size == 0:
        return w
    if w.size < size:
        return window_hashes(w, list(range(w.size))) ^ _U64(w.size)
    return distinct(window_hashes(w, list(range(size))))


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x if x.size < 2 else x[np.concatenate(([True], x[1:] != x[:-1]))]
