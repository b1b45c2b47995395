"""Exact, near and line duplicates against brute force."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import pytest

from lakemart.llm import exact_dedup, line_dedup, ngram_join
from lakemart.llm.graph import components


class Forest:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def union(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def linked(sets, percent=75):
    """Components of an inverted-index join of {key: set}."""
    where, overlap, forest = defaultdict(list), Counter(), Forest()
    for k, s in sets.items():
        forest.find(k)
        for x in s:
            where[x].append(k)
    for ks in where.values():
        overlap.update(itertools.combinations(ks, 2))
    for (a, b), n in overlap.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            forest.union(a, b)
    return forest


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r.text)].append(r.doc_id)
    out = Counter()
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        out.update((i, keep, len(ids), sha) for i in ids)
    return out, len(groups)


def check_exact(df):
    got = exact_dedup.exact_duplicates(df).collect()
    want, groups = expected_exact(df.collect())
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == groups and all(r.doc_id == r.keep_id for r in kept)


def test_exact_duplicates(documents):
    check_exact(documents)


@pytest.mark.parametrize("partitions", [1, 7])
def test_exact_group_over_many_partitions(spark, partitions):
    """A group with most of the rows spreads over the range partitions and still is one group."""
    df = spark.range(3000).selectExpr(
        "id as doc_id", "case when id % 5 = 0 then concat('t', id) when id % 7 = 0 then 'a  b' "
        "else 'hot\\ttext' end as text")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check_exact(df)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_exact_awkward(awkward, no_docs):
    check_exact(awkward)
    assert exact_dedup.exact_duplicates(no_docs).count() == 0
    left = exact_dedup.drop_exact_duplicates(awkward)
    assert left.columns == awkward.columns
    rows = left.collect()
    assert len(rows) == len({norm(r.text) for r in awkward.collect()}) == \
        len({norm(r.text) for r in rows})
    assert exact_dedup.drop_exact_duplicates(no_docs).count() == 0


def test_near_duplicates(documents, corpus):
    sets = {r.doc_id: shingles(r.text) for r in corpus}
    forest = linked({k: s for k, s in sets.items()})
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in ngram_join.near_duplicates(documents).collect()}
    assert got == {k: (len(s), forest.find(k)) for k, s in sets.items()}
    assert len({c for _, c in got.values()}) < len(got)


def test_near_duplicates_of_a_large_group(spark):
    """Mutated copies near the bound, hubs that do not link with all, and a very common passage."""
    import random

    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    base, passage = [word() for _ in range(120)], [word() for _ in range(30)]
    texts = []
    for _ in range(150):
        w = list(base)
        for at in rng.sample(range(120), rng.randint(0, 5)):
            w[at] = word()
        texts.append(" ".join(w))
    texts += [" ".join([word() for _ in range(rng.randint(4, 25))] + passage) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    forest = linked(sets)
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(df).collect()}
    assert got == {i: forest.find(i) for i in sets}


def test_pairs_of_mutated_copies_grow_with_their_number(spark, monkeypatch):
    """Copies changed so much that many pairs don't link: the hubs link most, few pairs are left to list."""
    import random

    rng, made = random.Random(8), []
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    base, texts = [word() for _ in range(150)], []
    for _ in range(400):
        w = list(base)
        for at in rng.sample(range(150), rng.randint(0, 8)):
            w[at] = word()
        texts.append(" ".join(w))
    staged = ngram_join.stage

    def counted(df, name):
        out = staged(df, name)
        made.append((name, out.count()))
        return out

    monkeypatch.setattr(ngram_join, "stage", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    forest = linked(sets)
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(df).collect()}
    assert got == {i: forest.find(i) for i in sets}
    assert len(set(got.values())) > 20
    pairs = [n for name, n in made if name == "ngram-pairs"]
    assert pairs[-1] <= len(texts)


@pytest.mark.parametrize("earlier", (1, 8))
def test_cross_pairs_are_all_plausible_ones(spark, monkeypatch, earlier):
    """Also where rows share an id: each plausible pair of labels is listed, whatever is listed once."""
    import random

    monkeypatch.setattr(ngram_join, "EARLIER", earlier)
    rng = random.Random(earlier)
    rows = []
    for i in range(70):
        size = rng.randint(30, 44)
        # rows of one id have one label
        rows += [(c, i % 60, size, place, i % 60 if i % 60 % 3 else 3)
                 for place, c in enumerate(sorted(rng.sample(range(-30, 30), 18)))]
    need = lambda x, y: -(-75 * (x[2] + y[2]) // 175)
    want = {(x[1], y[1]) for x in rows for y in rows
            if x[0] == y[0] and x[1] < y[1] and x[4] != y[4]
            and x[3] <= x[2] - need(x, y) and y[3] <= y[2] - need(x, y)}
    entries = spark.createDataFrame(rows, "col long, a long, size_a long, place_a long, component long")
    got = ngram_join.cross_pairs(entries, 75).collect()
    assert want and {(r.a, r.b) for r in got} == want and len(got) == len(want)


def test_near_duplicates_split_columns(spark, monkeypatch, documents, corpus):
    """Columns that are dealt to several blocks, and set aside from two rows on, lose no link."""
    monkeypatch.setattr(ngram_join, "LONG_COLUMN", 2)
    monkeypatch.setattr(ngram_join, "SHORT_COLUMN", 2)
    sets = {r.doc_id: shingles(r.text) for r in corpus}
    forest = linked(sets)
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(documents).collect()}
    assert got == {k: forest.find(k) for k in sets}


def test_near_awkward(awkward, no_docs):
    rows = awkward.collect()
    sets = {r.doc_id: shingles(r.text) for r in rows if r.doc_id is not None}
    forest = linked({k: s for k, s in sets.items()})
    got = ngram_join.near_duplicates(awkward).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(
        (r.doc_id, len(shingles(r.text)), None if r.doc_id is None else forest.find(r.doc_id))
        for r in rows)
    assert forest.find(4) == forest.find(6) and forest.find(7) == forest.find(8)
    assert ngram_join.near_duplicates(no_docs).count() == 0
    left = ngram_join.keep_one_of_each(awkward)
    assert left.columns == awkward.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted(
        r.doc_id for r in rows if r.doc_id is not None and forest.find(r.doc_id) == r.doc_id)


def test_components(spark):
    import random

    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + \
        [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)] + [(7, 7), (9000, 9000)]
    forest = Forest()
    for a, b in edges:
        if a != b:
            forest.union(a, b)
    got = {r.node: r.component for r in components(
        spark.createDataFrame(edges + edges[:50], "a long, b long")).collect()}
    assert got == {x: forest.find(x) for x in forest.up}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def line_sets(rows):
    lines = {}
    for r in rows:
        for i, x in enumerate((r.text or "").split("\n") if r.text is not None else ()):
            if n := x.lower().strip(" \t\r\x0b\x0c"):
                lines[(r.doc_id, i)] = n
    sets = {n: {m[1] for m in re.finditer(r"(?s)(?<!\S)(?=(\S.{0,11}))", n)}
            for n in set(lines.values())}
    return lines, sets


def expected_lines(rows):
    lines, sets = line_sets(rows)
    forest, groups = linked(sets), defaultdict(list)
    for at, n in lines.items():
        groups[forest.find(n)].append(at)
    low = lambda at: (at[0] is not None, at[0] or 0, at[1])
    return {at: (*min(g, key=low), len(g)) for g in groups.values() if len(g) > 1 for at in g}


def test_duplicate_lines(documents, corpus):
    """High-recall banding: every pair it can miss is near the bound; on this table it misses none."""
    got = line_dedup.duplicate_lines(documents).collect()
    assert {(r.doc_id, r.line_no): (r.keep_id, r.keep_line_no, r.n_lines) for r in got} == \
        expected_lines(corpus)
    assert all(r.kept == ((r.doc_id, r.line_no) == (r.keep_id, r.keep_line_no)) for r in got)


def test_lines_awkward(awkward, no_docs):
    rows = awkward.collect()
    got = line_dedup.duplicate_lines(awkward).collect()
    assert {(r.doc_id, r.line_no): (r.keep_id, r.keep_line_no, r.n_lines) for r in got} == \
        expected_lines(rows)
    assert line_dedup.duplicate_lines(no_docs).count() == 0
    left = line_dedup.drop_duplicate_lines(awkward)
    assert left.columns == awkward.columns and left.count() == len(rows)
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[13] == "line\n" and texts[10] == "" and texts[0] is None


def test_lines_by_shingles_at_every_position(spark):
    """URLs and texts without blanks, alike in their first twelve characters alone, or nearly whole."""
    han = "".join(chr(0x4E00 + 7 * i) for i in range(200))
    lines = ["https://www.example.com/a/1", "https://www.example.org/zz", han[:80], han[:12] + han[90:150],
             han[2:80], han[:78] + "\U0001f600\U0001f601", "\U0001f600" * 9 + "a", "\U0001f600" * 9 + "b",
             "a-word-of-more-than-twelve-characters and more text here",
             "a-word-of-more-than-twelve-cha and more text here", "short", "short", "shorter"]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    every = {x: {x[i:i + 12] for i in range(max(1, len(x) - 11))} for x in set(lines)}
    forest, groups = linked(every), defaultdict(list)
    for i, x in enumerate(lines):
        groups[forest.find(x)].append(i)
    want = {i: (min(g), len(g)) for g in groups.values() if len(g) > 1 for i in g}
    got = line_dedup.duplicate_lines(df, every_position=True).collect()
    assert {r.doc_id: (r.keep_id, r.n_lines) for r in got} == want
    left = {r.doc_id: r.text for r in line_dedup.drop_duplicate_lines(df).collect()}
    assert [i for i in left if left[i] == ""] and all(
        (left[i] == "") == (i in want and want[i][0] != i) for i in left)
    assert left[1] and left[3] and not left[4]


def test_bands_have_the_stated_recall(spark):
    """Pairs of sets of similarity 0.75 with 12 and 20 hashes in the union share a band as stated."""
    import random

    from pyspark.sql import functions as F

    rng, n = random.Random(5), 4000
    for union in (12, 20):
        rows = []
        for pair in range(n):
            h = [rng.getrandbits(64) - (1 << 63) for _ in range(union)]
            alone = union // 8
            rows += [(2 * pair, x) for x in h[alone:]]
            rows += [(2 * pair + 1, x) for x in h[:alone] + h[union // 4:]]
        bands = line_dedup._bands(spark.createDataFrame(rows, "node long, hash long"))
        met = (bands.select("node", F.explode("bands").alias("band"))
               .groupBy(F.expr("node div 2").alias("pair"), "band").count().where("count = 2")
               .select("pair").distinct().count())
        # both sets hold all but ``alone`` (or a quarter less ``alone``) of the union: 3/4 in common
        assert met / n > 0.984 - 4 * (0.984 * 0.016 / n) ** 0.5


def test_line_dedup_is_native(documents):
    plan = line_dedup.duplicate_lines(documents.limit(50))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_line_hashes_of_all_kinds_and_a_long_line(spark):
    """Cut from bytes or by pattern, a shingle has one hash; a line's time doesn't grow with its square."""
    import time

    from pyspark.sql import functions as F

    lines = ["", "short", "exactly 12 c", "a" * 75, "b c " * 19, "x" * 63 + "é" + "y" * 70, "\U0001f600" * 30,
             "".join(chr(97 + i * i % 23) for i in range(300)), "tab\there and a bell\x07 and\x00more of it"]
    df = spark.createDataFrame([(x,) for x in lines], "norm string").repartition(2)
    got = line_dedup._hashes(df, True).groupBy("node").agg(F.sort_array(F.collect_list("hash")).alias("of"))
    want = df.select(F.xxhash64("norm").alias("node"), F.explode(F.transform(
        line_dedup.shingles(F.col("norm"), True), lambda x: F.xxhash64(x))).alias("hash")) \
        .groupBy("node").agg(F.sort_array(F.collect_list("hash")).alias("of"))
    assert {(r.node, *r.of) for r in got.collect()} == {(r.node, *r.of) for r in want.collect()}
    began = time.monotonic()
    long = spark.range(1).select(F.expr("repeat('abc def-', 75000)").alias("norm"))
    assert line_dedup._hashes(long, True).distinct().count() == 8
    assert time.monotonic() - began < 20


def test_line_minima_from_one_scan_and_several_shingles_a_row(spark):
    """Characters of one byte and of several go one way, and rows of several hashes have the same minima."""
    lines = ["short", "exactly 12 c", "x" * 63 + "é" + "y" * 700, "\U0001f600" * 30 + "漢字",
             "".join(chr(97 + i * i % 23) for i in range(1000))]
    df = spark.createDataFrame([(x,) for x in lines], "norm string").repartition(2)
    plan = line_dedup._hashes(df, True)._jdf.queryExecution().toString()
    assert not re.search("Union|regexp", plan)
    several, single = ({r.node: r.bands for r in line_dedup._bands(x).collect()} for x in (
        line_dedup._rows(df, True), line_dedup._hashes(df, True)))
    assert several == single and len(single) == len(lines)
