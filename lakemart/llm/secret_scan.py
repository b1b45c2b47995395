"""Secrets in texts, with a random forest against false positives.

Wide patterns find candidates: long runs of key-like characters that hold digits or mixed
case, values of any length and marks assigned to secrets' names (:data:`SECRET_NAMES`),
and tokens of well-known formats.  A random
forest then judges each finding by its length, how likely its character
transitions are in the corpus' own words, how much of it the corpus' words cover,
where it stands (the source's share of findings, its place in the text) and the
words beside it.  The forest learns from labelled findings: a table of them if the
caller has one, else findings that strict rules can label.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import map_arrow, stage

#: Labelled findings of each class that the forest is fitted on, about; all if there are fewer.
FIT_ROWS = 5000
TREES, DEPTH, SEED = 40, 8, 17
#: Distinct words that a task counts before it hands the counts on.
TASK_WORDS = 200_000
#: Words in the dictionary: the most frequent.
DICTIONARY = 20_000
#: Characters of context on each side.
CONTEXT = 48
# Names that secrets are assigned to, and formats that issuers publish.
SECRET_NAMES = ("access_key api_key apikey auth auth_token bearer client_secret credential "
                "passphrase passwd password private_key pwd secret secret_key token").split()
ISSUED = {
    "aws": r"(?:AKIA|ASIA)[0-9A-Z]{16}",
    "github": r"gh[pousr]_[0-9A-Za-z]{36}",
    "google": r"AIza[0-9A-Za-z_-]{35}",
    "slack": r"xox[abprs]-[0-9A-Za-z-]{10,}",
    "stripe": r"[sr]k_(?:live|test)_[0-9A-Za-z]{16,}",
    "jwt": r"eyJ[0-9A-Za-z_-]{8,}\.eyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}",
}
PLACEHOLDERS = ("changeme dummy example fake placeholder redacted sample test todo xxxx your").split()
_KEY_CHARS = r"[0-9A-Za-z_+/=.-]"
_CANDIDATE = re.compile(
    "|".join(f"(?P<{k}>(?<!{_KEY_CHARS}){v})" for k, v in ISSUED.items())
    + rf"|(?P<run>(?<!{_KEY_CHARS})(?={_KEY_CHARS}*[0-9]|[0-9A-Za-z+/=_-]*[a-z][A-Z]){_KEY_CHARS}{{16,}})")
_SIGN = re.compile(r"=>|:=|={1,3}|:{1,2}")
# a name, perhaps in quotes or with a type, that ends before the sign
_NAME = re.compile("(?i:" + "|".join(n.replace("_", "[_-]?") for n in SECRET_NAMES)
                   + r")(?![a-z])[\w-]{0,20}[\"'`]?\]?(?:\s{0,3}:\s{0,3}[\w.|\[\]]{1,30})?\s{0,3}\Z")
_VALUE = re.compile(r"\s{0,3}(?:\"((?:[^\"\\\n]|\\.)+)\"|'((?:[^'\\\n]|\\.)+)'|`([^`\n]+)`|([^\s\"'`]\S*))")
_OPENS = {")": "(", "]": "[", "}": "{", ">": "<"}
_ASSIGNED = re.compile(r"([A-Za-z][A-Za-z_.-]{0,40})[\"']?\s{0,3}(?:=|:|=>|:=)\s{0,3}[\"']?\Z")
_WORD = re.compile(r"[^\W\d_]+")
_PAIR = re.compile(r"(?=([a-z]{2}))")
FEATURES = ("length", "digits", "upper", "lower", "marks", "hex", "distinct", "entropy",
            "transitions", "coverage", "longest_word", "switches", "assigned", "secret_name",
            "quoted", "placeholder", "issued", "position", "source_findings", "near_known",
            "near_secret")
_SHIFT = 96  # character classes of the transition table: ASCII from 32 on


def _language(docs: DataFrame) -> tuple[np.ndarray, frozenset[str]]:
    """Log-probabilities of ASCII character transitions in words, and the frequent words.

    Over all texts, counted in each task first; at most a table of 26 x 26 and
    :data:`DICTIONARY` words come to the driver.
    """
    def counted(seen: Counter) -> pa.RecordBatch:
        pairs: Counter = Counter()
        for word, n in seen.items():
            for pair in _PAIR.findall(word):
                pairs[pair] += n
        return pa.RecordBatch.from_arrays(
            [pa.array([False] * len(seen) + [True] * len(pairs), pa.bool_()),
             pa.array([*seen, *pairs], pa.string()),
             pa.array([*seen.values(), *pairs.values()], pa.int64())], ["pair", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for text in b.column("text"):
                seen.update(_WORD.findall((text.as_py() or "").lower()))
                if len(seen) >= TASK_WORDS:
                    yield counted(seen)
                    seen.clear()
        yield counted(seen)

    tally = stage(map_arrow(docs.select("text"), run, "pair boolean, word string, n long")
                  .groupBy("pair", "word").agg(F.sum("n").alias("n")), "secret-words")
    words, pairs = tally.where("not pair"), tally.where("pair")
    counts = np.full((_SHIFT, _SHIFT), 0.5)
    for r in pairs.collect():  # at most 26 x 26
        counts[ord(r.word[0]) - 32, ord(r.word[1]) - 32] += r.n
    table = np.log(counts / counts.sum(axis=1, keepdims=True))
    top = words.where("length(word) >= 3").orderBy(F.desc("n"), "word").limit(DICTIONARY).collect()
    return table, frozenset(r.word for r in top)


def _bare(value: str) -> str:
    """A value without quotes, less the punctuation and closing brackets that follow it."""
    while value and (value[-1] in "\"'`,;" or _OPENS.get(value[-1], value) not in value):
        value = value[:-1]
    return value


def candidates(text: str) -> list[tuple[int, str, str]]:
    """(start, value, kind) of every candidate, in order of start.

    A run of key characters inside an assigned value is a piece of it and gives no row;
    an issued format inside one does.
    """
    runs = [(m.start(), m[0].rstrip(".=-"), m.lastgroup) for m in _CANDIDATE.finditer(text)]
    assigned = {}
    for sign in _SIGN.finditer(text):
        if not _NAME.search(text[max(0, sign.start() - 2 * CONTEXT):sign.start()]):
            continue
        m = _VALUE.match(text, sign.end())
        if m and (value := m[m.lastindex] if m.lastindex < 4 else _bare(m[4])):
            assigned[m.start(m.lastindex)] = value
    spans, out, last = sorted(assigned.items()), [], 0
    for start, value, kind in runs:
        while last < len(spans) and spans[last][0] + len(spans[last][1]) <= start:
            last += 1
        inside = [(a, v) for a, v in spans[last:last + 1]
                  if a <= start and start + len(value) <= a + len(v)]
        if inside and inside[0] == (start, value):
            del assigned[start]
            spans.pop(last)
        elif inside and kind == "run":
            continue
        out.append((start, value, kind))
    return sorted(out + [(a, v, "assigned") for a, v in assigned.items()])


def _covered(value: str, known: frozenset[str]) -> tuple[float, int]:
    """Share of a candidate's characters in dictionary words (greedy, longest first), and the longest."""
    low, i, covered, longest = value.lower(), 0, 0, 0
    while i < len(low):
        for n in range(min(14, len(low) - i), 2, -1):
            if low[i:i + n] in known:
                covered, longest, i = covered + n, max(longest, n), i + n
                break
        else:
            i += 1
    return covered / max(1, len(low)), longest


def _measure(value: str, before: str, after: str, kind: str, position: float,
             table: np.ndarray, known: frozenset[str]) -> list[float]:
    """The features but for the source's, in order; 0 stands in for that one."""
    n = len(value)
    code = np.clip(np.frombuffer(value.lower().encode("ascii", "replace"), np.uint8).astype(int) - 32,
                   0, _SHIFT - 1)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "m"
             for c in value]
    share = Counter(kinds)
    seen = Counter(value)
    entropy = -sum(x / n * math.log2(x / n) for x in seen.values())
    coverage, longest = _covered(value, known)
    name = _ASSIGNED.search(before)
    near = _WORD.findall(before.lower())[-3:] + _WORD.findall(after.lower())[:2]
    low = value.lower()
    return [float(n), share["d"] / n, share["u"] / n, share["l"] / n, share["m"] / n,
            sum(c in "0123456789abcdef" for c in low) / n, len(seen) / n, entropy,
            float(table[code[:-1], code[1:]].mean()) if n > 1 else 0.0, coverage, float(longest),
            sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / n, float(bool(name)),
            float(bool(name) and any(s in name[1].lower() for s in SECRET_NAMES)),
            float(before[-1:] in "\"'`" and before[-1:] != "" and after[:1] in "\"'`"),
            float(any(p in low for p in PLACEHOLDERS)), float(kind not in ("run", "assigned")), position, 0.0,
            sum(w in known for w in near) / max(1, len(near)),
            float(any(s in w for w in near for s in SECRET_NAMES))]


def rule_label(features: list[float], value: str) -> int | None:
    """1 or 0 for findings that strict rules can label, else None.

    Secrets: assigned to a secret's name and without words in them, or of an issued format.
    False: placeholders, numbers alone, and strings that are mostly words, but for quoted
    values without blanks of secrets' names: they may be passphrases.
    """
    f = dict(zip(FEATURES, features, strict=True))
    named = f["secret_name"] and f["quoted"] and not re.search(r"\s", value)
    if f["placeholder"] or (f["coverage"] > 0.6 and not named) or not re.search("[A-Za-z]", value):
        return 0
    keyed = f["quoted"] or re.search("[0-9]|[a-z][A-Z]", value)
    if f["issued"] or (f["secret_name"] and keyed and f["coverage"] < 0.3
                       and f["distinct"] * len(value) >= 8):
        return 1
    if named:
        return None
    if re.fullmatch(r"[0-9./:+-]*", value) or value.count(".") > 2 or "@" in value:
        return 0
    return None


_FOUND = "id {}, source string, start int, end int, value string, kind string, " \
         "features array<double>, rule int"


def _find(docs: DataFrame, id_col: str, text_col: str, path_col: str | None) -> DataFrame:
    """Every candidate of every whole text with its features."""
    language = docs.sparkSession.sparkContext.broadcast(
        _language(docs.select(F.col(text_col).alias("text"))))
    kind_of_id = docs.schema[id_col].dataType.simpleString()
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       path.alias("source"))
    id_type = pa.int64() if kind_of_id == "bigint" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = language.value
        for b in batches:
            at, out = [], []
            for n, text in enumerate(b.column("text")):
                text = text.as_py() or ""
                for start, value, kind in candidates(text):
                    end = start + len(value)
                    f = _measure(value, text[max(0, start - CONTEXT):start], text[end:end + CONTEXT],
                                 kind, start / len(text), table, known)
                    at.append(n)
                    out.append((start, end, value, kind, f, rule_label(f, value)))
            take = pa.array(at, pa.int32())
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            ids = b.column("id").take(take)
            yield pa.RecordBatch.from_arrays(
                [ids if id_type is None else ids.cast(id_type), b.column("source").take(take),
                 pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                 pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string()),
                 pa.array(cols[4], pa.list_(pa.float64())), pa.array(cols[5], pa.int32())],
                ["id", "source", "start", "end", "value", "kind", "features", "rule"])

    found = stage(map_arrow(rows, run, _FOUND.format(kind_of_id)), "secret-candidates")
    # the path: how many findings its source has, on a logarithmic scale
    per_source = found.groupBy("source").agg(F.log1p(F.count("*")).alias("n_source"))
    at = FEATURES.index("source_findings")
    same = F.col("source").eqNullSafe(F.col("s_source"))
    return found.join(per_source.withColumnRenamed("source", "s_source"), same, "left").withColumn(
        "features", F.transform("features", lambda x, i: F.when(i == at, F.col("n_source")).otherwise(x))) \
        .drop("n_source", "s_source")


def _fit(labelled: DataFrame, fit_rows: int) -> RandomForestClassificationModel | None:
    """A forest on about ``fit_rows`` labelled findings of each class; None without both classes."""
    n = {r.label: r.n for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return None
    draw = F.pmod(F.xxhash64("id", "start", "value", F.lit("forest")), F.lit(1 << 20))
    share = F.when(F.col("label") == 1, fit_rows / n[1]).otherwise(fit_rows / n[0])
    drawn = stage(labelled.where(draw < share * (1 << 20)).select(
        F.col("label").cast("double").alias("label"),
        array_to_vector("features").alias("features")), "secret-fit")
    if drawn.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(drawn)


def scan(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id",
         text_col: str = "text", path_col: str | None = "source",
         fit_rows: int = FIT_ROWS) -> DataFrame:
    """A row for each candidate: id, start, end (code points, end exclusive), value, kind, score, secret.

    ``findings`` holds labelled ones (``id_col``, start, end, label 0 or 1); without it,
    or where it has but one class, strict rules label what they can.  Candidates that a strict rule labels keep its
    verdict only where no forest can be fitted.  Null and empty texts give no rows;
    repeated rows give repeated ones.  Columns other than the named ones aren't read.
    """
    found = _find(docs, id_col, text_col, path_col)
    model = None
    if findings is not None:
        known = findings.where(F.col("label").isin(0, 1)).select(
            F.col(id_col).alias("id"), F.col("start").cast("int").alias("start"),
            F.col("end").cast("int").alias("end"), "label").distinct()
        model = _fit(found.join(known, ["id", "start", "end"]), fit_rows)
    if model is None:
        model = _fit(found.where("rule is not null").withColumnRenamed("rule", "label"), fit_rows)
    if model is None:
        score = F.coalesce(F.col("rule").cast("double"), F.lit(0.5))
        judged = found.withColumn("score", score)
    else:
        vectors = found.withColumn("vector", array_to_vector("features"))
        model = model.setFeaturesCol("vector").setProbabilityCol("p")
        judged = model.transform(vectors).withColumn("score", vector_to_array("p")[1])
    return judged.select(F.col("id").alias(id_col), "start", "end", "value", "kind", "score",
                         (F.col("score") >= 0.5).alias("secret"))
