"""Packing documents into token windows by multiway differencing.

A document is its token ids and an end id.  Whole windows are cut off its front
as they are; the tails are packed in groups: each tail, cut at powers of two,
starts as a partial partition of the group into ``k`` windows, and the two
partial partitions with the largest imbalance are merged over and over, the
fullest window of one on the emptiest of the other (Karmarkar-Karp).  That
leaves near-equal windows; when one exceeds the capacity the group is packed
again into one window more.  Groups are filled to a little under the capacity,
so that this is rare.  What a task has left over goes into windows whose length
is a power of two, which need no padding.

Documents are packed where they are read: no shuffle, and a task holds one group.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import byte_bpe
from lakemart.llm.common import map_arrow

WINDOW = 1024
#: Windows packed together, and ids left free in each of them on average.
GROUP, SLACK = 64, 12
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
_FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
_ARROW = pa.schema([(f, pa.int64()) for f in _FIELDS])
_WIDTH = 4  # bytes of an id


class TextTokenizer:
    """Token ids (little-endian unsigned 32-bit) of whole texts, added tokens' strings as their ids."""

    def __init__(self, path: str):
        self._encoding, _ = byte_bpe.load(path)

    def encode(self, text: str) -> bytes:
        return np.asarray(self._encoding.encode_to_numpy(text, allowed_special="all"), "<u4").tobytes()


def difference(sizes: list[int], k: int) -> tuple[np.ndarray, list[tuple]]:
    """Karmarkar-Karp: ``k`` near-equal sums (falling) and the items of each."""
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(k, np.int64)
        sums[0] = size
        heap.append((-size, i, sums, [(i,)] + [()] * (k - 1)))
    heapq.heapify(heap)
    for serial in range(len(sizes), 2 * len(sizes) - 1):
        _, _, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        sums = a + b[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        items = [in_a[j] + in_b[k - 1 - j] for j in order.tolist()]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), serial, sums, items))
    return heap[0][2], heap[0][3]


def balanced(sizes: list[int], k: int, capacity: int) -> list[tuple]:
    """The items of each window; more than ``k`` windows if one would exceed ``capacity``."""
    while True:
        sums, items = difference(sizes, k)
        if sums[0] <= capacity:
            return [w for w in items if w]
        k += 1


class _Packer:
    """Packs the documents of one task; ``rows`` collects finished pieces."""

    def __init__(self, task: int, window: int):
        self.window, self.next_id = window, task << 36
        self.rows: list[tuple] = []
        self.tails: list[tuple[int, int, int, bytes]] = []  # doc_id, start, doc_tokens, ids
        self.held = 0

    def add(self, doc_id, ids: bytes) -> None:
        n, w = len(ids) // _WIDTH, self.window
        whole = n - n % w
        for start in range(0, whole, w):
            self._put([(doc_id, start, n, ids[start * _WIDTH:(start + w) * _WIDTH])])
        rest, full = (doc_id, whole, n, ids[whole * _WIDTH:]), GROUP * (w - SLACK)
        while rest and rest[3]:
            size = len(rest[3]) // _WIDTH
            take, rest = self._cut(rest, min(size, full - self.held))
            self.tails.append(take)
            self.held += len(take[3]) // _WIDTH
            if self.held == full:
                self._pack(GROUP)

    @staticmethod
    def _cut(piece, size):
        doc_id, start, n, ids = piece
        after = (doc_id, start + size, n, ids[size * _WIDTH:]) if len(ids) > size * _WIDTH else None
        return (doc_id, start, n, ids[:size * _WIDTH]), after

    def _put(self, pieces) -> None:
        offset = 0
        for doc_id, start, n, ids in pieces:
            size = len(ids) // _WIDTH
            self.rows.append((doc_id, start, size, zlib.crc32(ids), n, self.next_id, offset))
            offset += size
        self.next_id += 1

    def _pack(self, k: int) -> None:
        pieces = []
        for rest in self.tails:
            for power in (self.window // 2, self.window // 4):
                if rest and len(rest[3]) // _WIDTH >= power:
                    piece, rest = self._cut(rest, power)
                    pieces.append(piece)
            if rest:
                pieces.append(rest)
        sizes = [len(p[3]) // _WIDTH for p in pieces]
        for items in balanced(sizes, k, self.window):
            self._put([pieces[i] for i in items])
        self.tails, self.held = [], 0

    def finish(self) -> None:
        """The last group: as many near-full windows as it fills, the rest in powers of two."""
        k = self.held // (self.window - SLACK)
        spare = self.held - k * (self.window - SLACK)
        if k:
            spare = min(self.held, -(-spare // 32) * 32)
        while spare:
            room, pieces = 1 << (min(spare, self.window).bit_length() - 1), []
            spare -= room
            self.held -= room
            while room:
                tail = self.tails.pop()
                size = min(room, len(tail[3]) // _WIDTH)
                piece, rest = self._cut(tail, size)
                pieces.append(piece)
                if rest:
                    self.tails.append(rest)
                room -= size
            self._put(pieces)
        if self.tails:
            self._pack(k)


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document in a window; see :data:`SCHEMA`.

    A null or empty text is the end id alone; a null id stays null; repeated
    rows are packed each on its own.  An empty table gives no rows.  Sequence
    ids depend on the task's number, so read ``docs`` from files or a staged
    table: there a lost task gets the same rows again.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        packer = _Packer(TaskContext.get().partitionId(), window)

        def rows():
            out, packer.rows = packer.rows, []
            cols = zip(*out, strict=True) if out else [[]] * len(_FIELDS)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                              schema=_ARROW)

        for b in batches:
            for doc_id, text in zip(b.column("id").to_pylist(), b.column("text"), strict=True):
                packer.add(doc_id, tokenizer.encode(text.as_py() or "") + end)
                if len(packer.rows) >= 20_000:
                    yield rows()
        packer.finish()
        yield rows()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, run, SCHEMA)


_LOADED: dict[str, TextTokenizer] = {}


def _tokenizer(path: str) -> TextTokenizer:
    """One tokenizer for each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = TextTokenizer(path)
    return _LOADED[path]
