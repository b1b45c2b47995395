"""Curve search and vector codes against brute force."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import types as T

from lakemart.llm import curve_search, vector_codes
from tests.llm.conftest import CLASHING, SMALL


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.read.parquet(f"{SMALL}/embeddings.parquet").repartition(3)


def table_of(spark, rows, parts=3):
    """(vec_id, embedding, label) with extra columns of clashing names."""
    schema = T.StructType([T.StructField("vec_id", T.LongType()),
                           T.StructField("embedding", T.ArrayType(T.DoubleType())),
                           T.StructField("label", T.IntegerType()),
                           *[T.StructField(c, T.StringType()) for c in (*CLASHING, "x", "vec", "h1", "p", "code")]])
    return spark.createDataFrame([(*r, *["z"] * (len(CLASHING) + 5)) for r in rows], schema).repartition(parts)


def brute_neighbours(rows, k=20, every=20):
    """rows: {id: vector}; {query: [(id, score)]}."""
    out = {}
    for q, a in rows.items():
        if q % every == 0:
            scores = [(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in rows.items() if i != q]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def neighbours(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize(("dims", "bits"), [(1, 6), (2, 5), (3, 3), (4, 2), (6, 2)])
def test_curve_visits_every_cell_in_steps(dims, bits):
    side = 1 << bits
    grid = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
    place = curve_search.hilbert(grid, bits)
    assert sorted(place) == list(range(side ** dims))
    assert (np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_search_against_brute_force(vectors):
    rows = {r.vec_id: r.embedding for r in vectors.collect()}
    expected = brute_neighbours(rows)
    got = neighbours(curve_search.search(vectors.where("vec_id % 20 = 0"), vectors))
    assert got.keys() == expected.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) / 20 for q in expected]
    assert sum(hits) / len(hits) >= 0.9
    for q, found in got.items():
        for i, score in found:
            assert score == pytest.approx(sum(x * y for x, y in zip(rows[q], rows[i], strict=True)), abs=1e-12)


def test_search_recall_where_windows_are_narrow(spark, monkeypatch):
    """Clustered vectors of unequal norms, many blocks: the fitted windows hold the neighbours."""
    monkeypatch.setattr(curve_search, "BLOCK", 64)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16)) * 3
    rows = {i: (centres[rng.integers(40)] + rng.normal(size=16) * 0.3).tolist() for i in range(4000)}
    df = table_of(spark, [(i, v, 0) for i, v in rows.items()])
    expected = brute_neighbours(rows, 10, 40)
    got = neighbours(curve_search.search(df.where("vec_id % 40 = 0"), df, 10))
    hits = [len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) / 10 for q in expected]
    assert sum(hits) / len(hits) >= 0.9


def test_search_awkward(spark):
    """Nulls, zeros, odd lengths, copies (a third of all), ties and repeats have defined results."""
    rng = np.random.default_rng(1)
    good = {i: rng.integers(-2, 3, 4).astype(float).tolist() for i in range(1, 90)}
    good = {i: v for i, v in good.items() if any(v)}
    good |= {i: [1.0, 2.0, -1.0, 0.5] for i in range(100, 145)}
    rows = [(i, v, 1) for i, v in good.items()]
    odd = [(None, [1.0, 1.0, 1.0, 1.0], 1), (500, None, None), (520, [0.0] * 4, 1), (540, [], 1),
           (560, [1.0, None, 0.0, 0.0], 1), (580, [1.0, math.nan, 0.0, 0.0], 1),
           (600, [math.inf, 0.0, 0.0, 0.0], 1), (620, [1.0, 2.0], 1)]
    df = table_of(spark, rows + odd + rows[:3] + rows[-2:])
    got = neighbours(curve_search.search(df.where("vec_id % 20 = 0"), df))
    assert got == brute_neighbours(good)  # few rows: every window holds all, so ties are exact
    few = table_of(spark, [(20, [1.0, 0.0], 1), (3, [0.5, 0.0], 1), (4, [-1.0, 0.0], 1)])
    assert neighbours(curve_search.search(few.where("vec_id = 20"), few)) == {20: [(3, 0.5), (4, -1.0)]}
    assert neighbours(curve_search.search(few.limit(0), few)) == {}
    assert neighbours(curve_search.search(few, few.limit(0))) == {}
    assert curve_search.search(few.limit(0), few.limit(0)).columns == ["query_id", "rank", "vec_id", "score"]


def brute_codes(rows):
    """rows: [(id, vector, label)], usable ones; {(id, label, vector): (code, error)}, label sums, sha."""
    x = [([math.floor(4096 * c) for c in v], i, lab) for i, v, lab in rows]
    dim = len(x[0][0])
    cuts = [p * dim // 8 for p in range(9)]
    part = lambda v, p: v[cuts[p]:cuts[p + 1]]
    first = sorted(x, key=lambda r: (r[1] is None, r[1] or 0))[:16]
    books = [[part(v, p) for v, _, _ in first] for p in range(8)]

    def nearest(v, book):
        d = [sum((a - b) ** 2 for a, b in zip(v, e, strict=True)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(6):
        new = []
        for p in range(8):
            groups = {}
            for v, _, _ in x:
                groups.setdefault(nearest(part(v, p), books[p])[0], []).append(part(v, p))
            new.append([[sum(c) // len(groups[e]) for c in zip(*groups[e], strict=True)] if e in groups else old
                        for e, old in enumerate(books[p])])
        books = new
    out, sums = [], {}
    for v, i, lab in x:
        near = [nearest(part(v, p), books[p]) for p in range(8)]
        out.append((i, "".join(f"{e:02x}" for e, _ in near), sum(d for _, d in near), lab))
        sums[lab] = sums.get(lab, 0) + out[-1][2]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, code, err, sums[lab], sha) for i, code, err, lab in out), key=str)


def codes(df):
    return sorted((tuple(r) for r in vector_codes.encode(df).collect()), key=str)


def test_codes_against_brute_force(vectors):
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    assert codes(vectors) == brute_codes(rows)


@pytest.mark.parametrize("memo", [1 << 17, 40])
def test_codes_awkward(spark, monkeypatch, memo):
    """Unusable rows go; ties, copies, repeats, null labels and ids, odd lengths, a small cell memory."""
    monkeypatch.setattr(vector_codes, "MEMO_CELLS", memo)
    rng = np.random.default_rng(2)
    good = [(i, (rng.integers(-3, 4, 13) / 8).tolist(), [None, 1, 2][i % 3]) for i in range(60)]
    good += [(i, good[7][1], 5) for i in range(100, 130)] + [good[3], good[3]]
    odd = [(None, None, 1), (200, None, None), (201, [], 1), (202, [0.0] * 12 + [None], 1),
           (203, [math.nan] * 13, 1), (204, [-math.inf] * 13, 1), (205, [1.0], 1)]
    assert codes(table_of(spark, good + odd)) == brute_codes(good)
    assert codes(table_of(spark, good[:5])) == brute_codes(good[:5])
    assert codes(table_of(spark, odd[:2])) == []
    none = table_of(spark, good).limit(0)
    assert vector_codes.encode(none).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert codes(none) == []


def test_cells_keep_every_nearest_entry():
    """Random codebooks and points, with hash clashes forced: the memory changes no result."""
    rng = np.random.default_rng(3)
    for bits in (0, 2, 5):
        entries = rng.integers(-60, 60, (16, 3))
        entries[4] = entries[9]
        cells = vector_codes.Cells(entries)
        cells.bits = bits
        if bits == 2:
            cells._hash = lambda c: (c[:, 0] & 1).astype(np.uint64)
        for _ in range(3):
            x = rng.integers(-90, 90, (500, 3))
            d = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
            at, far = cells.nearest(x)
            assert (at == d.argmin(axis=1)).all() and (far == d.min(axis=1)).all()
