"""The pipeline against its operators' brute force, stage by stage, and its registration."""

from collections import Counter

import corpus_pipeline as P
from lakemart.llm.common import stage, table

from .conftest import SMALL
from .test_dedup import linked, norm, shingles


def through(spark, docs, n):
    out = [docs]
    for name, apply in P.STAGES[:n]:
        out.append(stage(apply(spark, out[-1], SMALL), f"test-{name}"))
    return out


def test_stages(spark, documents):
    raw, known, exact, near, clean, packed = through(spark, documents, 5)
    for kept in (known, exact, near, clean):
        assert kept.schema.simpleString() == raw.schema.simpleString()
    rows = {k: df.collect() for k, df in (("raw", raw), ("known", known), ("exact", exact),
                                          ("near", near), ("clean", clean))}
    ids = {k: {r.doc_id for r in v} for k, v in rows.items()}
    assert ids["known"] == {r.doc_id for r in rows["raw"] if any(c.isalpha() for c in r.text or "")}
    first = {}
    for r in rows["known"]:
        first[norm(r.text)] = min(r.doc_id, first.get(norm(r.text), r.doc_id))
    assert ids["exact"] == set(first.values())
    forest = linked({r.doc_id: shingles(r.text) for r in rows["exact"]})
    assert ids["near"] == {r.doc_id for r in rows["exact"] if forest.find(r.doc_id) == r.doc_id}
    # every dropped document shares a long run of words with a benchmark item, no kept one does
    items = [r.text.lower().split() for r in table(spark, SMALL, "benchmark").collect()]
    runs = {tuple(w[i:i + 12]) for w in items for i in range(len(w) - 11)}

    def leaks(text):
        w = (text or "").lower().split()
        return any(tuple(w[i:i + 12]) in runs for i in range(len(w) - 11))

    assert ids["clean"] == {r.doc_id for r in rows["near"] if not leaks(r.text)}
    assert Counter(r.doc_id for r in packed.where("start = 0").collect()) == \
        Counter(r.doc_id for r in rows["clean"])


def test_awkward(spark, awkward, no_docs):
    out = through(spark, awkward, 5)
    assert all(df.columns == awkward.columns for df in out[:-1])
    assert {r.doc_id for r in out[-1].collect()} == {r.doc_id for r in out[-2].collect()}
    assert through(spark, no_docs, 5)[-1].count() == 0


def test_registered(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline"} | {f"op{n}_" for n in range(1, 11)} <= names | {
        f"{q.split('_')[0]}_" for q in names}
    assert set(entry.oracle_sql()) <= names
    assert [n for n, _ in P.STAGES] == ["language_id", "exact_dedup", "ngram_join",
                                        "decontamination", "packing"]


def test_workers_give_memory_back(spark, documents):
    """What a batch took is not kept by the worker, which the later stages share the executor with."""
    import numpy as np
    import pyarrow as pa

    def held(batches):
        def mb():
            with open("/proc/self/statm") as f:
                return int(f.read().split()[1]) * 4096 >> 20

        for _ in batches:
            before = mb()
            parts = [pa.array(np.ones(100_000 + k), pa.float32(), safe=False) for k in range(0, 400_000, 4_000)]
            parts += [np.ones(1_000_000) for _ in range(20)]
            most = mb()
            del parts
            yield pa.RecordBatch.from_arrays([pa.array([pa.default_memory_pool().backend_name]), pa.array([
                most - before]), pa.array([mb() - before])], ["pool", "taken", "kept"])

    P.identify_language(spark, documents, SMALL)
    row = spark.range(1).coalesce(1).mapInArrow(held, "pool string, taken long, kept long").first()
    assert row.pool == "system" and row.taken > 100 and row.kept < 30
