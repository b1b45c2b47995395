"""Toxic passages as maximum-scoring segments of token log-odds.

Every word feature (a whole word, or the first letters of one) has the log-odds
of toxic against other labelled texts that hold it, with a Dirichlet prior in
proportion to the feature's pooled frequency, so that rare features shrink to none;
features whose z-score is small are dropped.  Texts are counted, not occurrences: one
text that repeats a word says little about the word.  A word takes the score of its most certain
feature, and a small negative score without one.  A linear scan then finds all
maximal-scoring segments of a text.  Under extreme-value statistics the chance
that clean text of this length has a segment of score S is
``1 - exp(-K n exp(-lambda S))``; segments that are unlikely enough are the toxic
passages, their surplus over the expected best is summed, and a logistic curve
turns the sum into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import held_out, map_arrow, stage

#: Labelled rows of each class that the model is fitted on, about; all if there are fewer.
FIT_ROWS = 6000
#: Features of a word: itself, and its first letters, as many as here.
PREFIXES = (5, 6, 7)
#: Least z-score of a feature that counts, and the most features of either sign.
MIN_Z, MAX_FEATURES = 3.5, 20_000
#: Weight of the prior, in texts; bound of a score; score of a word without a feature.
PRIOR, MOST, NEUTRAL = 50.0, 5.0, -0.1
#: A segment is significant when clean text of its length holds one as good this rarely.
SIGNIFICANT = 0.2
CACHE_WORDS = 300_000
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _features(word: str) -> list[str]:
    """The whole word as such (a leading blank marks it), then prefixes shorter than it."""
    return [" " + word, *(word[:n] for n in PREFIXES if len(word) > n)]


def _draw(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
          fit_rows: int) -> tuple[DataFrame, float]:
    """(text, toxic) of about ``fit_rows`` labelled rows of each class, drawn by a hash of the id;
    and the share of toxic rows."""
    rows = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    n = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("toxic")), F.lit(1 << 20))
    share = F.when(F.col("toxic") == 1, fit_rows / n.get(1, 1)).otherwise(fit_rows / n.get(0, 1))
    drawn = rows.where(draw < share * (1 << 20)).distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # two classes of about fit_rows ids: a bounded side
    found = stage(texts.join(F.broadcast(drawn), "id").select("text", "toxic"), "toxic-fit")
    return found, n.get(1, 0) / max(1, sum(n.values()))


def _count(rows: DataFrame) -> DataFrame:
    """In how many texts of each class every feature stands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_feature = (Counter(), Counter())
        for b in batches:
            for text, toxic in zip(b.column("text"), b.column("toxic").to_pylist(), strict=True):
                by_feature[toxic].update({f for w in set(words_of(text.as_py())) for f in _features(w)})
        names = list({**by_feature[0], **by_feature[1]})
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()),
             *(pa.array([c[f] for f in names], pa.int64()) for c in by_feature)],
            ["feature", "clean", "toxic"])

    return (map_arrow(rows, run, "feature string, clean long, toxic long").groupBy("feature")
            .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) of positive score, in linear time.

    Segments are kept in a list; a new positive score joins earlier ones only when
    that gives more than both (Ruzzo and Tompa).  Each kept segment knows the nearest
    earlier one with a smaller sum before it: what a search has passed is not passed again.
    """
    out: list[list[float]] = []  # start, end, sum before, sum after, place of that earlier one or -1
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        start, j = i, len(out) - 1
        while True:
            while j >= 0 and out[j][2] >= before:
                j = out[j][4]
            if j < 0 or out[j][3] >= total:
                out.append([start, i + 1, before, total, j])
                break
            joined, (start, _, before, _, earlier) = j, out[j]
            j = earlier
            del out[joined:]
    return [(a, b, hi - lo) for a, b, lo, hi, _ in out]


class ToxicityModel:
    """Scores of features, the null distribution of the best segment, and the final curve."""

    def __init__(self, features: dict[str, tuple[float, float]]):
        self.features = features  # score, z
        self.rate, self.size = 1.0, 1.0  # lambda and K
        self.slope, self.middle = 1.0, 0.0
        self._cache: dict[str, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "_cache": {}}

    def _score(self, word: str) -> float:
        best = (NEUTRAL, 0.0)
        for f in _features(word):
            found = self.features.get(f)
            if found and abs(found[1]) > abs(best[1]):
                best = found
        if len(self._cache) >= CACHE_WORDS:
            self._cache.clear()
        self._cache[word] = best[0]
        return best[0]

    def scores(self, words: list[str]) -> list[float]:
        got = list(map(self._cache.get, words))
        return [self._score(w) if s is None else s for w, s in zip(words, got, strict=True)] \
            if None in got else got

    def significant(self, found: list[tuple[int, int, float]], n_words: int):
        """(first word, end, score, p-value) of those of the segments that are unlikely enough."""
        base = self.size * max(1, n_words)
        for first, end, s in found:
            p = -math.expm1(-base * math.exp(-min(self.rate * s, 700)))
            if p <= SIGNIFICANT:
                yield first, end, s, p

    def evidence(self, found: list[tuple[int, int, float]], n_words: int) -> float:
        """Sum over significant segments of lambda S - ln(K n); without one, that of the best."""
        base = math.log(max(self.size * max(1, n_words), 1e-9))
        sums = [self.rate * s - base for _, _, s, _ in self.significant(found, n_words)]
        if sums:
            return sum(sums)
        return min(0.0, self.rate * max((s for _, _, s in found), default=0.0) - base)

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * (evidence - self.middle)))))


def _judged(rows: DataFrame, model: ToxicityModel) -> tuple[list, dict[float, int]]:
    """For the calibration: (toxic, words, segment scores) of each text of the sample, and how
    often each word score occurs in its clean texts."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            out = []
            for text, toxic in zip(b.column("text"), b.column("toxic").to_pylist(), strict=True):
                scores = shared.value.scores(words_of(text.as_py()))
                out.append((toxic, len(scores), [s for _, _, s in segments(scores)], None))
                if not toxic:
                    seen.update(round(s, 2) for s in scores)
            yield rows_of(out)
        yield rows_of([(None, n, None, s) for s, n in seen.items()])

    def rows_of(out):
        cols = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()),
             pa.array(cols[2], pa.list_(pa.float64())), pa.array(cols[3], pa.float64())],
            ["toxic", "n", "best", "word_score"])

    judged = stage(map_arrow(rows, run, "toxic int, n long, best array<double>, word_score double"),
                   "toxic-judged")
    texts = [(r.toxic, r.n, r.best) for r in judged.where("toxic is not null").collect()]
    scores = judged.where("toxic is null").groupBy("word_score").agg(F.sum("n").alias("n"))
    return texts, {r.word_score: r.n for r in scores.collect()}


def _calibrate(model: ToxicityModel, texts: list, word_scores: dict[float, int],
               share: float) -> None:
    """lambda from clean word scores, K from clean best segments, then the curve.

    ``share``: of toxic texts among all labelled ones, which the draw may not keep."""
    values, n = np.array(list(word_scores), float), np.array(list(word_scores.values()), float)
    model.rate = 1.0
    if values.size and values.max() > 0:
        lo, hi = 0.0, 1.0
        mean = lambda rate: float((n * np.exp(rate * values)).sum() / n.sum()) - 1
        while mean(hi) < 0 and hi < 16:
            hi *= 2
        for _ in range(50):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if mean(mid) < 0 else (lo, mid)
        model.rate = max(hi, 0.05)
    clean = [(size, max(best, default=0.0)) for toxic, size, best in texts if not toxic and size]
    weight = sum(size * math.exp(-model.rate * s) for size, s in clean)
    model.size = max(len(clean) / weight, 1e-6) if weight else 1.0
    x = np.array([min(40.0, model.evidence([(0, 0, s) for s in best], size))
                  for _, size, best in texts])
    y = np.array([toxic for toxic, _, _ in texts], float)
    if not y.any() or y.all():
        model.slope, model.middle = 1.0, (0.0 if y.any() else 1e9)
        return
    # a logistic curve by damped Newton steps; the classes weigh as among all labelled texts
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    a, c = 0.0, math.log(share / (1 - share))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * x + c, -30, 30)))
        d = weight * (y - p)
        g = np.array([(d * x).sum() - 1e-3 * a, d.sum()])
        v = weight * p * (1 - p) + 1e-9
        h = np.array([[(v * x * x).sum() + 1e-3, (v * x).sum()], [(v * x).sum(), v.sum()]])
        step = np.linalg.solve(h, g)
        a, c = a + float(np.clip(step[0], -1, 1)), c + float(np.clip(step[1], -5, 5))
    model.slope, model.middle = (a, -c / a) if a > 1e-6 else (1.0, 1e9)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """A model from labelled texts (labels 0 and 1; others and null are left out).

    A classifier fitted on a bounded sample: about ``fit_rows`` rows of each class.
    The driver gets at most ``MAX_FEATURES`` features of each sign, and the segment
    scores of the sample's texts.
    """
    rows, share = _draw(docs, labels, id_col, text_col, label_col, fit_rows)
    counts = stage(_count(rows), "toxic-counts")
    total = rows.agg(F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") == 1)).first()
    n_clean, n_toxic = total
    if not n_clean or not n_toxic:
        model = ToxicityModel({})
        model.middle = 1e9
        return model
    prior = PRIOR * (F.col("clean") + F.col("toxic")) / float(n_clean + n_toxic)
    t, c = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(t / (n_toxic + PRIOR + 1 - t)) - F.log(c / (n_clean + PRIOR + 1 - c))
    scored = counts.where("clean + toxic >= 5").select(
        "feature", odds.alias("odds"), (odds / F.sqrt(1 / t + 1 / c)).alias("z"))
    kept = [scored.where(F.col("z") * sign >= MIN_Z).orderBy(F.desc(F.abs("z")), "feature")
            .limit(MAX_FEATURES) for sign in (1, -1)]
    features = {r.feature: (max(-MOST, min(MOST, r.odds)), r.z)
                for r in kept[0].union(kept[1]).collect()}
    model = ToxicityModel(features)
    _calibrate(model, *_judged(rows, model), share)
    return model


_SCORED = "id {}, score double, passages array<struct<first_word:int,n_words:int,score:double,p:double>>"


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``id_col``, score (0 to 1) and the significant passages of every row's whole text.

    Null and empty texts, and texts without letters, have no passages and get the
    curve's value for no evidence.  Repeated rows come back repeated; only the two
    named columns are read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = pa.list_(pa.struct([("first_word", pa.int32()), ("n_words", pa.int32()),
                                  ("score", pa.float64()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for b in batches:
            scores, passages = [], []
            for text in b.column("text"):
                words = words_of(text.as_py())
                found = segments(judge.scores(words))
                scores.append(judge.probability(judge.evidence(found, len(words))))
                passages.append([{"first_word": x, "n_words": y - x, "score": s, "p": p}
                                 for x, y, s, p in judge.significant(found, len(words))])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(scores, pa.float64()), pa.array(passages, passage)],
                ["id", "score", "passages"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, run, _SCORED.format(kind)).withColumnRenamed("id", id_col)


def toxicity_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A model learned outside the held-out fold, applied to every row of ``docs``."""
    model = fit(docs, labels.where(~held_out("doc_id")))
    return score(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"))
