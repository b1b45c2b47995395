"""Language identification by rank-order n-gram profiles.

A language's profile is the ranked list of its most frequent character n-grams
(one to three letters, a blank at word edges).  A document gets the language
whose profile is nearest by out-of-place distance: each of the document's own
most frequent n-grams adds how far its rank is from the language's, and the
profile length if the language lacks it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import held_out, map_arrow

#: n-grams in a profile, of a language and of a document.
PROFILE = 300
#: Rows a language's profile is fitted on, about (drawn by a hash of the id); all if it has fewer.
FIT_ROWS = 4000
UNDETERMINED = "und"
_BITS = 21  # of a code point
_BLANK = 32
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _grams(text: str | None) -> np.ndarray:
    """All one- to three-letter n-grams of a text, as numbers; empty if it has no letter."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _is_letter()[code]
    if not letter.any():
        return np.empty(0, np.int64)
    framed = np.full(code.size + 2, _BLANK, np.int64)
    framed[1:-1] = np.where(letter, code, _BLANK)
    blank = framed == _BLANK
    c = framed[~(blank & np.concatenate(([False], blank[:-1])))]  # one blank between words
    pairs = (c[:-1] << _BITS) | c[1:]
    triples = (pairs[:-1] << _BITS) | c[2:]
    return np.concatenate((c[c != _BLANK], pairs, triples))


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    grams = np.sort(grams)
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    return grams[first], np.diff(np.append(first, grams.size))


def _ranked(grams: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` most frequent n-grams, ties by their number."""
    values, counts = _counted(grams)
    return values[np.argsort(-counts, kind="stable")[:n]]


def fit_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                 id_col: str = "doc_id", size: int = PROFILE,
                 fit_rows: int = FIT_ROWS) -> dict[str, np.ndarray]:
    """Ranked n-grams of each language from labelled rows (null labels are left out).

    A classifier fitted on a bounded sample: about ``fit_rows`` rows of each
    language, drawn by a hash of the id, or all where there are fewer.  What
    comes back is bounded by languages times ``size``.
    """
    rows = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    shares = rows.groupBy("lang").agg((F.lit(float(fit_rows)) / F.count("*")).alias("share"))
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("fit")), F.lit(1 << 20))
    drawn = (rows.join(F.broadcast(shares), "lang")  # a row for each language
             .where(draw < F.col("share") * (1 << 20)).select("lang", "text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_lang: dict[str, list] = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text"), strict=True):
                grams = _grams(text.as_py())
                if grams.size:
                    by_lang.setdefault(lang, []).append(grams)
            for lang, parts in by_lang.items():
                values, counts = _counted(np.concatenate(parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * values.size, pa.string()), pa.array(values),
                     pa.array(counts, pa.int64())], ["lang", "gram", "n"])

    totals = (map_arrow(drawn, count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = (totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
           .select("lang", "gram", "rank").collect())
    profiles: dict[str, np.ndarray] = {}
    for lang in sorted({r.lang for r in top}):
        profiles[lang] = np.array([r.gram for r in sorted(
            (r for r in top if r.lang == lang), key=lambda r: r.rank)], np.int64)
    return profiles


class _Distances:
    """Out-of-place distances of a document's ranked n-grams to all profiles at once."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.langs, self.size = sorted(profiles), size
        self.grams = np.unique(np.concatenate([*profiles.values(), np.empty(0, np.int64)]))
        self.rank = np.full((self.grams.size + 1, len(self.langs)), -1, np.int64)
        for j, lang in enumerate(self.langs):
            at = np.searchsorted(self.grams, profiles[lang])
            self.rank[at, j] = np.arange(at.size)

    def nearest(self, ranked: np.ndarray) -> tuple[str, float]:
        at = np.searchsorted(self.grams, ranked)
        at[at < self.grams.size] = np.where(
            self.grams[at[at < self.grams.size]] == ranked[at < self.grams.size],
            at[at < self.grams.size], self.grams.size)
        rank = self.rank[at]
        place = np.arange(ranked.size)[:, None]
        gap = np.where(rank < 0, self.size, np.abs(rank - place)).sum(axis=0)
        best = int(np.argmin(gap))
        return self.langs[best], float(1 - gap[best] / (self.size * ranked.size))


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], id_col: str = "doc_id",
             text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """``id_col``, lang_pred and score of every row's whole text.

    score is 1 at distance 0 and 0 at the greatest distance.  A null text, one
    without letters, or no profiles at all give ``und`` and 0; equally near
    languages give the first by name.  Reads the two named columns only.
    """
    judge = _Distances(profiles, size)
    id_type = docs.schema[id_col].dataType

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores = [], []
            for text in b.column("text"):
                grams = _grams(text.as_py())
                lang, score = (judge.nearest(_ranked(grams, size)) if grams.size and judge.langs
                               else (UNDETERMINED, 0.0))
                langs.append(lang)
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = map_arrow(rows, predict,
                    f"id {id_type.simpleString()}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


def language_rows(docs: DataFrame) -> DataFrame:
    """Profiles learned outside the held-out fold, applied to every row of ``docs``."""
    learn = docs.where(~held_out("doc_id"))
    found = identify(docs, fit_profiles(learn))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, profiles: dict[str, np.ndarray],
                    accept: set[str] | None = None, id_col: str = "doc_id",
                    text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """``docs`` without the rows whose language is undetermined, or not in ``accept``.

    Texts are judged as they stream by; all columns pass through unchanged.
    """
    judge = _Distances(profiles, size)
    at = docs.columns.index(text_col)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for text in b.column(at):
                grams = _grams(text.as_py())
                lang = (judge.nearest(_ranked(grams, size))[0] if grams.size and judge.langs
                        else UNDETERMINED)
                keep.append(lang != UNDETERMINED and (accept is None or lang in accept))
            yield b.filter(pa.array(keep, pa.bool_()))

    return map_arrow(docs, sift, docs.schema)
