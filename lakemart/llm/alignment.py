"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Every tokenizer gives a token-byte incidence matrix (a row for each token, a column for each byte), held
as compressed sparse rows.  The overlap links are the nonzeros of A Bᵀ, computed row by row as
Gustavson does: a row of the product gathers the rows of Bᵀ that the row of A points at.  Byte
offsets where tokens of both end cut the tokens into groups; the shared-group links are the
product of the two token-group incidences, made in blocks of rows of bounded size.

How often an id pair is linked is counted over the whole corpus.  Texts are processed in blocks of
bounded size: a block contributes each of its pairs once, with a count, and gets back that pair's total,
so a pair that fills a third of the corpus is a row for each block, and nothing depends on the vocabulary
fitting into a broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import byte_bpe
from lakemart.llm.common import map_arrow, reach_workers, stage

#: Texts of a block have about so many bytes together (a longer text is a block of its own).
BLOCK_BYTES = 16 << 20
#: Products of the shared-group links that are held at once.
LINK_BLOCK = 1 << 20


@dataclass
class Rows:
    """Compressed sparse rows: row i has ``value[k]`` in column ``col[k]``, starts[i] <= k < starts[i+1]."""

    starts: np.ndarray
    col: np.ndarray
    value: np.ndarray
    width: int

    @classmethod
    def runs(cls, lengths: np.ndarray) -> "Rows":
        """Row i has ones in the next ``lengths[i]`` columns: tokens by bytes, or groups by tokens."""
        starts = np.concatenate(([0], np.cumsum(lengths)))
        n = int(starts[-1])
        return cls(starts, np.arange(n), np.ones(n, np.int64), n)

    def part(self, i: int, j: int) -> "Rows":
        """The rows from ``i`` up to ``j``."""
        at = slice(self.starts[i], self.starts[j])
        return Rows(self.starts[i:j + 1] - self.starts[i], self.col[at], self.value[at], self.width)

    def transposed(self) -> "Rows":
        """Columns as rows, by a counting sort of the nonzeros."""
        row = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        starts = np.concatenate(([0], np.cumsum(np.bincount(self.col, minlength=self.width))))
        if (self.col[1:] >= self.col[:-1]).all():
            return Rows(starts, row, self.value, len(self.starts) - 1)
        order = np.argsort(self.col, kind="stable")
        return Rows(starts, row[order], self.value[order], len(self.starts) - 1)


def flops(a: Rows, b: Rows) -> np.ndarray:
    """The symbolic part of a·b: how many products each row of ``a`` gathers."""
    per = np.concatenate(([0], np.cumsum(np.diff(b.starts)[a.col])))
    return per[a.starts[1:]] - per[a.starts[:-1]]


def gustavson(a: Rows, b: Rows) -> Rows:
    """a·b: every row of ``a`` gathers the rows of ``b`` that it points at, and adds equal columns up."""
    sizes = np.diff(b.starts)[a.col]
    row = np.repeat(np.arange(len(a.starts) - 1), np.diff(a.starts))
    if (sizes == 1).all():  # one product for each nonzero, such as one token for each byte
        at, key, value = b.starts[a.col], row * b.width, a.value
    else:
        ends = np.cumsum(sizes)
        at = np.arange(int(ends[-1])) + np.repeat(b.starts[a.col] - (ends - sizes), sizes)
        key, value = np.repeat(row * b.width, sizes), np.repeat(a.value, sizes)
    key, value = key + b.col[at], value * b.value[at]
    if key.size and (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if key.size else key
    value = np.add.reduceat(value, first) if key.size else value
    key = key[first]
    row, col = (key // b.width, key % b.width) if key.size else (key, key)
    starts = np.searchsorted(row, np.arange(len(a.starts)))
    return Rows(starts, col, value, b.width)


def overlaps(a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers (of A, of B) of every pair that shares a byte; both cover the same bytes."""
    product = gustavson(Rows.runs(a_len), Rows.runs(b_len).transposed())
    return np.repeat(np.arange(len(a_len)), np.diff(product.starts)), product.col


def group_sizes(a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and of B in every group; a group ends where tokens of both end."""
    a_end, b_end = np.cumsum(a_len), np.cumsum(b_len)
    both = np.intersect1d(a_end, b_end, assume_unique=True)
    return (np.diff(np.searchsorted(a_end, both, "right"), prepend=0),
            np.diff(np.searchsorted(b_end, both, "right"), prepend=0))


def group_links(a_in: np.ndarray, b_in: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of every pair that shares a group: the product of both group incidences.

    Holds as many as there are; :func:`group_link_counts` holds a block of them."""
    product = gustavson(Rows.runs(a_in).transposed(), Rows.runs(b_in))
    return np.repeat(np.arange(int(a_in.sum())), np.diff(product.starts)), product.col


def group_link_counts(a_in: np.ndarray, b_in: np.ndarray, block: int = LINK_BLOCK) -> np.ndarray:
    """Shared-group links of every token of A: the nonzeros in its row of the product of both group incidences.

    The product is made in full, in blocks of rows of about ``block`` products, as the symbolic part
    foretells them, so that no more than these are held (a row has at most the text's B tokens).
    """
    a, b = Rows.runs(a_in).transposed(), Rows.runs(b_in)
    ends = np.cumsum(flops(a, b))
    parts, i = [], 0
    while i < len(ends):
        done = int(ends[i - 1]) if i else 0
        j = max(int(np.searchsorted(ends, done + block, "right")), i + 1)
        parts.append(np.diff(gustavson(a.part(i, j), b).starts))
        i = j
    return np.concatenate(parts) if parts else ends


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and how their ids are written."""

    _loaded: dict[tuple[str, str], "Tokenizers"] = {}

    @classmethod
    def of(cls, a_path: str, b_path: str) -> "Tokenizers":
        """The tokenizers of these files, loaded once in a process."""
        if (a_path, b_path) not in cls._loaded:
            cls._loaded[a_path, b_path] = cls(a_path, b_path)
        return cls._loaded[a_path, b_path]

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a, self.a_bytes = byte_bpe.load(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [self._piece(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.a_len = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_len = np.array([len(t) for t in self.b_bytes], np.int64)
        #: id with the mark that follows it: none, comma, bar or semicolon
        ids = range(max(len(self.a_bytes), len(self.b_bytes)))
        self.written = np.array([[f"{i}{mark}" for i in ids] for mark in ("", ",", "|", ";")], object)

    @staticmethod
    def _piece(piece: str) -> bytes:
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and of B; None for a text that either doesn't cover byte by byte."""
        if not text:
            return None
        raw = (" " + text).encode()
        a = self.a.encode_ordinary(" " + text)
        if b"".join([self.a_bytes[x] for x in a]) != raw:
            return None
        b = self.b.encode(text, num_threads=1)
        if b"".join([self.b_bytes[x] for x in b]) != raw:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def write_groups(self, a: np.ndarray, b: np.ndarray, a_in: np.ndarray, b_in: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group, of A and then of B."""
        a_end, b_end = np.cumsum(a_in), np.cumsum(b_in)
        n = len(a) + len(b)
        ids, mark = np.empty(n, np.int64), np.ones(n, np.int64)
        ids[np.arange(len(a)) + np.repeat(b_end - b_in, a_in)] = a
        ids[np.arange(len(b)) + np.repeat(a_end, b_in)] = b
        mark[a_end + (b_end - b_in) - 1] = 2
        mark[a_end + b_end - 1] = 3
        mark[-1] = 0
        return "".join(self.written[mark, ids].tolist())


def packed(pairs: np.ndarray) -> bytes:
    """Pair numbers as bytes: their count, whether each takes 4 or 8 bytes, and the compressed numbers."""
    wide = pairs.size and int(pairs.max()) >> 32
    raw = pairs.astype("<u8" if wide else "<u4").tobytes()
    return (np.array([pairs.size, 8 if wide else 4], "<u8").tobytes()
            + pa.compress(raw, codec="zstd", asbytes=True))


def unpacked(links: pa.BinaryScalar) -> np.ndarray:
    """The pair numbers of a row's links: id of A times the size of B's vocabulary plus id of B."""
    raw = links.as_buffer()
    if not raw or not raw.size:
        return np.empty(0, np.int64)
    n, width = np.frombuffer(raw, "<u8", 2).tolist()
    if not n:
        return np.empty(0, np.int64)
    return np.frombuffer(pa.decompress(raw.slice(16), n * width, codec="zstd"),
                         f"<u{width}").astype(np.int64)


_ALIGNED = ("id long, block long, n_a long, n_b long, n_groups long, n_group_links long, "
            "n_links long, groups_sha256 string, links binary")


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
          text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, block, n_a, n_b, n_groups, n_group_links, n_links, groups_sha256
    and links, the numbers of the linked id pairs in order (see :func:`unpacked`).

    Null and empty texts, and texts that the tokens of A or of B don't spell byte by byte, have no
    tokens: zeros, an empty hash text and no links.  Ids may be null or repeated.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tok = Tokenizers.of(a_path, b_path)
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            out = []
            for i, text in zip(batch.column("id"), batch.column("text"), strict=True):
                i, text = i.as_py(), text.as_py()
                ids = tok.encode(text)
                held += len(text or "")
                if held > block_bytes:
                    block, held = block + 1, len(text or "")
                if ids is None:
                    out.append((i, block, 0, 0, 0, 0, 0, "", b""))
                    continue
                a, b = ids
                a_len, b_len = tok.a_len[a], tok.b_len[b]
                at_a, at_b = overlaps(a_len, b_len)
                a_in, b_in = group_sizes(a_len, b_len)
                links = packed(a[at_a] * len(tok.b_bytes) + b[at_b])
                out.append((i, block, len(a), len(b), len(a_in), int(group_link_counts(a_in, b_in).sum()),
                            len(at_a), hashlib.sha256(tok.write_groups(a, b, a_in, b_in).encode())
                            .hexdigest(), links))
            if out:
                names = [c.split()[0] for c in _ALIGNED.split(", ")]
                kinds = [pa.int64()] * 7 + [pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, work, _ALIGNED)


def block_pairs(aligned: DataFrame) -> DataFrame:
    """(block, pair, n): how often each id pair is linked in each block."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(block, parts):
            pair, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(pair), block)), pa.array(pair), pa.array(n)], ["block", "pair", "n"])

        held: list[np.ndarray] = []
        now = None
        for b in batches:  # a block's rows stand together, in one file
            blocks = b.column("block").to_numpy()
            cuts = np.flatnonzero(np.diff(blocks)) + 1
            for i, j in zip([0, *cuts], [*cuts, len(blocks)], strict=True):
                if i == j:
                    continue
                if now is not None and blocks[i] != now:
                    yield rows(now, held)
                    held = []
                now = blocks[i]
                held += [unpacked(v) for v in b.column("links").slice(i, j - i)]
        if now is not None:
            yield rows(now, held)

    return map_arrow(aligned.select("block", "links"), count, "block long, pair long, n long")


def corpus_counts(pairs: DataFrame, b_size: int) -> DataFrame:
    """(pair, count, is_best): corpus-wide links of an id pair, and whether its B id (of ``b_size``) has
    no more with any other A id."""
    total = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    b_id = F.col("pair") % b_size
    best = total.groupBy(b_id.alias("b")).agg(F.max("count").alias("most"))
    return (total.withColumn("b", b_id).join(best, "b")
            .select("pair", "count", (F.col("count") == F.col("most")).alias("is_best")))


def alignment(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
              text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``id_col``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_group_links by document.

    n_best: links whose pair has its B id's highest corpus-wide count (ties included); count_sum: the
    counts of all links' pairs added up.  See :func:`align` for null, empty and odd texts; repeated
    rows are documents of their own, and an empty table gives no rows.  Only the two named columns
    are read.
    """
    reach_workers(docs.sparkSession)
    aligned = stage(align(docs, a_path, b_path, id_col, text_col, block_bytes), "alignment-links")
    pairs = stage(block_pairs(aligned), "alignment-pairs")
    b_size = len(Tokenizers.of(a_path, b_path).b_bytes)
    known = pairs.select("block", "pair").join(corpus_counts(pairs, b_size), "pair").select(
        "block", "pair", "count", "is_best")

    def score(docs_in: pa.Table, pairs_in: pa.Table) -> pa.Table:
        pair = pairs_in.column("pair").to_numpy()
        order = np.argsort(pair)
        pair = pair[order]
        count = pairs_in.column("count").to_numpy()[order]
        best = pairs_in.column("is_best").to_numpy()[order].astype(np.int64)
        n_best, count_sum = [], []
        for links in docs_in.column("links"):
            at = np.searchsorted(pair, unpacked(links))
            n_best.append(int(best[at].sum()))
            count_sum.append(int(count[at].sum()))
        out = docs_in.drop_columns(["links", "block"])
        return (out.append_column("n_best", pa.array(n_best, pa.int64()))
                .append_column("count_sum", pa.array(count_sum, pa.int64())))

    scored = (aligned.groupBy("block").cogroup(known.groupBy("block"))
              .applyInArrow(score, "id long, n_a long, n_b long, n_groups long, n_group_links long, "
                                   "n_links long, groups_sha256 string, n_best long, count_sum long"))
    return scored.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best",
                         "count_sum", "groups_sha256", "n_group_links")
