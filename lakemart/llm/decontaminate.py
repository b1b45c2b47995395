"""Benchmark decontamination by spaced seeds.

Fixed masks pick some of the words in a window and ignore the others, so a
window still hashes alike after substitutions at the ignored positions.  The
seeds of the benchmark are the query set; every document's seeds are looked up
in them, and each hit's diagonal (document position minus benchmark position)
is verified word by word: the best stretch in which at least three words in four
agree must be long enough.  The benchmark goes to the tasks in blocks of
bounded size, each block against all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import map_arrow, separators, window_hashes, word_hashes

#: Masks over consecutive words: 1 is compared, 0 ignored.
MASKS = ("1101011", "11100101", "10101101", "110010011")
#: Benchmark words in a block that is sent to the tasks (about 100 bytes each with seeds).
BLOCK_WORDS = 400_000
#: A stretch counts from this many words, or three quarters of a shorter item.
MIN_RUN = 13
#: Items of fewer words are too common to count as leaks, and ignored.
MIN_WORDS = 5
_U64 = np.uint64
_SIFT = 20  # bits of the first look-up
#: ASCII control and punctuation characters part words; letters are lower-cased.
_MARKS = bytes(c for c in range(128) if not chr(c).isalnum())
_SEPARATORS = separators(_MARKS)


def words_of(text: str | None) -> np.ndarray:
    """Hashes of a text's words: case, ASCII punctuation and spacing don't count."""
    return word_hashes((text or "").lower().encode("utf-8", "replace"), _SEPARATORS)


class SeedIndex:
    """Seeds of benchmark items: for each mask sorted hashes with item and position."""

    def __init__(self, items: list[tuple[int, str]], masks: tuple[str, ...] = MASKS):
        self.ids = [i for i, _ in items]
        self.words = [words_of(t) for _, t in items]
        shapes = {tuple(j for j, m in enumerate(mask) if m == "1") for mask in masks}
        span = max(s[-1] for s in shapes) + 1
        short = {w.size for w in self.words if MIN_WORDS <= w.size < span + 2}
        self.masks = []
        for shape in [*sorted(shapes), *(tuple(range(n)) for n in sorted(short))]:
            only = len(shape) if shape == tuple(range(len(shape))) else None
            found = [(window_hashes(w, list(shape)), n) for n, w in enumerate(self.words)
                     if w.size >= MIN_WORDS and only in (None, w.size)]
            hashes = np.concatenate([h for h, _ in found] or [np.empty(0, _U64)])
            item = np.concatenate([np.full(h.size, n) for h, n in found] or [np.empty(0, int)])
            place = np.concatenate([np.arange(h.size) for h, _ in found] or [np.empty(0, int)])
            order = np.argsort(hashes, kind="stable")
            sift = np.zeros(1 << _SIFT, bool)
            sift[hashes >> _U64(64 - _SIFT)] = True
            self.masks.append((list(shape), sift, hashes[order], item[order], place[order]))

    def diagonals(self, words: np.ndarray) -> set[tuple[int, int]]:
        """(item, document position minus item position) of every seed hit."""
        out: set[tuple[int, int]] = set()
        for shape, sift, hashes, item, place in self.masks:
            seeds = window_hashes(words, shape)
            at = np.flatnonzero(sift[seeds >> _U64(64 - _SIFT)])
            if not at.size or not hashes.size:
                continue
            lo = np.searchsorted(hashes, seeds[at], "left")
            n = np.searchsorted(hashes, seeds[at], "right") - lo
            hit = np.flatnonzero(n)
            if not hit.size:
                continue
            n, lo = n[hit], lo[hit]
            row = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            pairs = np.stack((item[row], np.repeat(at[hit], n) - place[row]), 1)
            out.update(map(tuple, np.unique(pairs, axis=0).tolist()))
        return out

    def verify(self, words: np.ndarray, item: int, shift: int) -> tuple[int, int, int] | None:
        """(first word, words, agreeing words) of the best stretch of a diagonal, if it counts.

        Agreement adds 1 and disagreement takes 3, so a stretch scores at least
        0 just when three words in four agree.
        """
        own = self.words[item]
        lo, hi = max(0, -shift), min(own.size, words.size - shift)
        same = words[lo + shift:hi + shift] == own[lo:hi]
        height = np.concatenate(([0], np.cumsum(np.where(same, 1, -3))))
        agreed = np.concatenate(([0], np.cumsum(same)))
        # the longest stretch whose score is not negative: the first low that a later
        # height reaches; lows are the falling records
        lows = np.flatnonzero(height <= np.minimum.accumulate(height))
        reach = np.maximum.accumulate(height[::-1])[::-1]
        best, upto = (0, 0, 0), 0
        for start in lows.tolist():
            upto = max(upto, start)
            while upto + 1 < height.size and reach[upto + 1] >= height[start]:
                upto += 1
            n = int(agreed[upto] - agreed[start])
            if n > best[2]:
                best = (start, upto - start, n)
        need = min(MIN_RUN, -(-3 * own.size // 4))
        if best[1] < need:
            return None
        return best[0] + lo + shift, best[1], best[2]

    def leaks(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, first word, words, agreeing words): the best verified stretch of each item."""
        words = words_of(text)
        best: dict[int, tuple[int, int, int]] = {}
        for item, shift in sorted(self.diagonals(words)) if words.size >= MIN_WORDS else ():
            if (found := self.verify(words, item, shift)) and (
                    item not in best or found[2] > best[item][2]):
                best[item] = found
        return [(item, *x) for item, x in sorted(best.items())]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int):
    """The benchmark's rows in blocks of about ``block_words`` words."""
    rows = benchmark.select(F.col(item_col).cast("long").alias("id"),
                            F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("id is not null")
    total = rows.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    blocks = -(-total // (4 * block_words)) or 1
    for k in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k)
        yield [(r.id, r.text) for r in part.orderBy("id", "text").collect()]


_LEAKS = ("id long, item_id long, first_word long, n_words long, agreeing long, item_words long")


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row for each document and benchmark item whose passage it holds.

    Columns: ``id_col``, ``item_col``, first_word, n_words, agreeing, item_words.
    Null and empty texts, and items with fewer than :data:`MIN_WORDS` words or a
    null id, match nothing; repeated rows give repeated results; an empty
    benchmark gives none.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = None
    for items in _blocks(benchmark, item_col, item_text_col, block_words):
        shared = spark.sparkContext.broadcast(SeedIndex(items))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for b in batches:
                found = [(doc_id, index.ids[item], first, n, same, index.words[item].size)
                         for doc_id, text in zip(b.column("id").to_pylist(), b.column("text"),
                                                 strict=True)
                         for item, first, n, same in index.leaks(text.as_py())]
                cols = zip(*found, strict=True) if found else [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in cols],
                    ["id", "item_id", "first_word", "n_words", "agreeing", "item_words"])

        part = map_arrow(rows, search, _LEAKS)
        out = part if out is None else out.unionByName(part)
    return out.withColumnsRenamed({"id": id_col, "item_id": item_col})


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text",
               block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage; all columns pass unchanged."""
    spark, at = docs.sparkSession, docs.columns.index(text_col)
    for items in _blocks(benchmark, item_col, item_text_col, block_words):
        shared = spark.sparkContext.broadcast(SeedIndex(items))

        def sift(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = [not shared.value.leaks(t.as_py()) for t in b.column(at)]
                yield b.filter(pa.array(keep, pa.bool_()))

        docs = map_arrow(docs, sift, docs.schema)
    return docs
