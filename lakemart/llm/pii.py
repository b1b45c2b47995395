"""Personal data by patterns, and by contexts that those bootstrap.

Four fixed patterns (email, ip, card, phone) give the base spans.  They are also
the seeds of a pattern-instance graph: an instance is an identifier-like string
(it holds digits), a pattern is the words next to it.  Scores pass back and forth
for a few rounds: a pattern is as good as the instances it surrounds, an instance as good as
its patterns together; seeds stay at 1.  Instances that high-confidence patterns
surround, and no fixed pattern matches, are added as spans of kind ``id``.

Everything is DataFrame expressions.  ``regexp_extract_all`` and ``split`` by the same
expression give the matches and the gaps between them; running sums of their lengths
are the offsets.  The expressions use possessive quantifiers and look-behind, so they
stay linear on long runs and match just what the plain ones do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import stage

KINDS = ("email", "ip", "card", "phone")
ADDED = "id"
#: Equal in matches to the plain expressions of the contract.
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
         r"(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: An identifier-like string: a run without white space, brackets or quotes that holds four digits
#: or an @.
_APART = r"\s\"'()<>\[\]{},;|"
CANDIDATE = (rf"(?<![^{_APART}])(?:(?:[^{_APART}0-9]*+[0-9]){{4}}|[^{_APART}@]*+@)[^{_APART}]*+")
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
#: Characters of context that are looked at on either side.
CONTEXT = 64
#: Rounds of scoring; a pattern's confidence and distinct seeds from which it extracts.
ROUNDS, CONFIDENCE, SUPPORT = 3, 0.8, 5
#: Weight of the unseen in a pattern's score.
SMOOTHING = 2.0


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = back.substr(i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    d = _digits(m)
    if kind == "card":
        return F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(F.lit(False))
    return F.length(d).between(10, 15)


def _found(text: Column, expression: str, worth: Column, made) -> Column:
    """``made(match, gap before, gap after)`` of every match; ``worth``: a cheap necessary condition."""
    matches = F.regexp_extract_all(text, F.lit(expression), F.lit(0))
    gaps = F.split(text, expression, -1)
    spans = F.transform(F.arrays_zip(matches.alias("m"), gaps.alias("g"),
                                     F.slice(gaps, 2, F.greatest(F.size(gaps), F.lit(1))).alias("h")),
                        lambda x: made(x["m"], x["g"], x["h"]))
    return F.when(worth, spans)


def _matches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row of ``docs``: a row number, the id, base matches and identifier-like strings."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = F.col("text")
    worth = {"email": F.contains(t, F.lit("@")), "ip": t.rlike("[0-9]\\.[0-9]"),
             "card": t.rlike("[0-9]"), "phone": F.contains(t, F.lit("+"))}
    expressions = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}

    def base(kind: str):
        return _found(t, expressions[kind], worth[kind], lambda m, g, h: F.struct(
            F.length(g).alias("gap"), F.length(m).alias("length"), _valid(kind, m).alias("ok")))

    candidates = _found(t, CANDIDATE, t.rlike("[0-9@]"), lambda m, g, h: F.struct(
        F.length(g).alias("gap"), F.length(m).alias("length"), m.alias("found"),
        F.substring(g, -CONTEXT, CONTEXT).alias("before"), F.substring(h, 1, CONTEXT).alias("after")))
    return stage(rows.select(F.monotonically_increasing_id().alias("row"), "id",
                             *(base(k).alias(k) for k in KINDS), candidates.alias("candidates")),
                 "pii-matches")


def _offsets(spans: DataFrame) -> DataFrame:
    """start and end of each span from the gaps and lengths of those before it (by row, kind, i)."""
    upto = Window.partitionBy("row", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("length")).over(upto)
    return spans.withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))


def _seeds(candidates: DataFrame, base: DataFrame) -> DataFrame:
    """The candidates, and whether each overlaps a base span of its row.

    Both lie in one order by start: a base span that begins no later must end after the
    candidate's start, or the next one begin before its end.  Two running extremes tell
    that, so a text with many spans costs a sort, not all their pairs.
    """
    both = candidates.unionByName(base.select("row", "start", "end", F.lit(True).alias("base")),
                                  allowMissingColumns=True)
    upto = Window.partitionBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = F.max(F.when(F.col("base"), F.col("end"))).over(upto.orderBy("start", F.desc("base")))
    following = F.min(F.when(F.col("base"), F.col("start"))).over(
        upto.orderBy(F.desc("start"), F.desc("base")))
    return (both.withColumn("reached", reached).withColumn("following", following).where("not base")
            .select("row", "start", "end", "before", "after", "instance",
                    F.coalesce(F.col("reached") > F.col("start"), F.lit(False)).alias("from_left"),
                    F.coalesce(F.col("following") < F.col("end"), F.lit(False)).alias("from_right"))
            .withColumn("seed", F.col("from_left") | F.col("from_right"))
            .drop("from_left", "from_right"))


def _contexts(found: DataFrame) -> DataFrame:
    """(instance, pattern, n): how often each string stands in each context."""
    word = r"[\p{L}\p{N}=:#]+"
    before = F.regexp_extract_all(F.lower("before"), F.lit(word), F.lit(0))
    after = F.regexp_extract_all(F.lower("after"), F.lit(word), F.lit(0))
    last, last2 = F.try_element_at(before, F.lit(-1)), F.try_element_at(before, F.lit(-2))
    follow = F.try_element_at(after, F.lit(1))
    patterns = F.filter(F.array(
        F.concat_ws(" ", last2, last, F.lit("_")), F.concat_ws(" ", last, F.lit("_"), follow),
        F.concat_ws(" ", last, F.lit("_"))), lambda p: p != "_")
    return found.withColumn("pattern", F.explode(F.array_distinct(patterns)))


def _bootstrap(found: DataFrame) -> DataFrame:
    """The high-confidence patterns: (pattern, confidence).

    ``found`` has instance, seed (boolean), before, after.  Only grouped sums and
    joins; no pattern's or instance's neighbours are gathered.
    """
    edges = stage(_contexts(found.select("instance", "seed", "before", "after"))
                  .groupBy("instance", "pattern").agg(F.count("*").alias("n"),
                                                      F.max("seed").alias("seed")), "pii-graph")
    scores = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("score"))
    patterns = None
    for k in range(ROUNDS):
        patterns = stage(edges.join(scores, "instance").groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("score")) / (F.sum("n") + SMOOTHING)).alias("confidence"),
            F.sum(F.col("seed").cast("long")).alias("support")), f"pii-patterns-{k}")
        unlike = F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.99))))
        scores = edges.join(patterns, "pattern").groupBy("instance").agg(
            F.when(F.max("seed"), 1.0).otherwise(1 - F.exp(unlike)).alias("score"))
    return patterns.where((F.col("confidence") >= CONFIDENCE) & (F.col("support") >= SUPPORT)) \
        .select("pattern", "confidence")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id and ``found``, an array of (kind, start, end, added), sorted.

    start and end count code points, the end is exclusive.  Spans of the four fixed
    patterns come by start, then kind as listed; added ones never overlap them.  A
    null text counts as empty and has none; repeated rows come back repeated, also
    with null ids.  Only the two named columns are read.
    """
    matches = _matches(docs, id_col, text_col)
    kind_of = {k: n for n, k in enumerate(KINDS)}
    spans = None
    for k, n in kind_of.items():
        part = matches.select("row", F.posexplode(k).alias("i", "x")).where("x.length is not null") \
            .select("row", F.lit(n).alias("kind"), "i", "x.gap", "x.length", "x.ok")
        spans = part if spans is None else spans.unionByName(part)
    base = stage(_offsets(spans).where("ok").select("row", "kind", "start", "end"), "pii-base")

    placed = _offsets(matches.select("row", F.posexplode("candidates").alias("i", "x"))
                      .where("x.length is not null")
                      .select("row", F.lit(len(KINDS)).alias("kind"), "i", "x.*"))
    core = F.regexp_replace("found", r"^[^\p{L}\p{N}+]+|[^\p{L}\p{N}]+$", "")
    candidates = placed.select("row", "start", "end", "before", "after",
                               F.lower(core).alias("instance"), F.lit(False).alias("base"))
    found = stage(_seeds(candidates, base), "pii-found")
    good = _bootstrap(found)
    added = (_contexts(found.where("not seed")).join(good, "pattern", "left_semi")
             .select("row", F.lit(len(KINDS)).alias("kind"), "start", "end").distinct())
    every = base.unionByName(added)
    names = F.array(*(F.lit(k) for k in (*KINDS, ADDED)))
    by_row = every.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end")))
                                      .alias("all")).select(
        "row", F.transform("all", lambda x: F.struct(
            names[x["kind"]].alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
            (x["kind"] == len(KINDS)).alias("added"))).alias("found"))
    return matches.select("row", "id").join(by_row, "row", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("found", F.array().cast(by_row.schema["found"].dataType)).alias("found"))


def personal_data_rows(docs: DataFrame) -> DataFrame:
    """Counts of base spans, their digest, and all spans, per row of ``docs``."""
    out = personal_data(docs)
    base = F.filter("found", lambda x: ~x["added"])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", *(count(k) for k in KINDS),
                      F.sha2(F.encode(joined(base), "UTF-8"), 256).alias("base_sha256"),
                      joined(F.col("found")).alias("spans"))
