"""Cross-tokenizer alignment against a byte-by-byte count."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from lakemart.llm import alignment, byte_bpe
from lakemart.llm.queries import tokenizer_path

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """(texts) -> spans of both tokenizers: [(id, start, end)], or None."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    byte = {c: i for c, i in byte_bpe.byte_alphabet().items()}

    def spans(ids, raws, whole):
        if b"".join(raws) != whole:
            return None
        out, at = [], 0
        for i, raw in zip(ids, raws, strict=True):
            out.append((i, at, at + len(raw)))
            at += len(raw)
        return out

    def both(text):
        if not text:
            return None
        whole = (" " + text).encode()
        ia = a.encode(" " + text, add_special_tokens=False).ids
        ib = b.encode(text)
        ra = [bytes(byte[c] for c in a.id_to_token(i)) for i in ia]
        rb = [bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else
              p.replace("▁", " ").encode() for p in map(b.id_to_piece, ib)]
        sa, sb = spans(ia, ra, whole), spans(ib, rb, whole)
        return (sa, sb) if sa is not None and sb is not None else None

    return both


def expected(rows, both):
    """Sorted result rows by plain loops over (id, text)."""
    made, totals = [], Counter()
    for i, text in rows:
        found = both(text)
        if found is None:
            made.append((i, 0, 0, 0, [], "", 0))
            continue
        sa, sb = found
        ends = sorted({e for _, _, e in sa} & {e for _, _, e in sb})
        links, j0 = [], 0
        for a, s, e in sa:
            while sb[j0][2] <= s:
                j0 += 1
            j = j0
            while j < len(sb) and sb[j][1] < e:
                links.append((a, sb[j][0]))
                j += 1
        groups, start, pairs, ia, ib = [], 0, 0, 0, 0
        for end in ends:
            ga, gb = [], []
            while ia < len(sa) and sa[ia][2] <= end:
                ga.append(sa[ia][0])
                ia += 1
            while ib < len(sb) and sb[ib][2] <= end:
                gb.append(sb[ib][0])
                ib += 1
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            pairs += len(ga) * len(gb)
        totals.update(links)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        made.append((i, len(sa), len(sb), len(groups), links, sha, pairs))
    most = Counter()
    for (_, b), n in totals.items():
        most[b] = max(most[b], n)
    return sorted(((i, na, nb, ng, len(links), sum(totals[x] == most[x[1]] for x in links),
                    sum(totals[x] for x in links), sha, pairs)
                   for i, na, nb, ng, links, sha, pairs in made), key=str)


def got(df, **more):
    return sorted((tuple(r) for r in alignment.alignment(df, A, B, **more).collect()), key=str)


def test_alignment_of_documents(documents, corpus, plain):
    assert got(documents, block_bytes=1 << 18) == expected([(r.doc_id, r.text) for r in corpus], plain)


def test_alignment_awkward(spark, awkward, no_docs, plain):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert got(awkward) == expected(rows, plain)
    assert got(no_docs) == []
    odd = ["a <|endoftext|> b", "<s>x</s> <unk>", " lead", "two  blanks", "▁under", "日本語の文章です", "\U0001f600é\x00\x07",
           "ends ", "\n", " ", "x" * 3000, "naïve café — ok"]
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string").repartition(4)
    assert got(df) == expected(list(enumerate(odd)), plain)


def test_products_are_matrix_products():
    rng = np.random.default_rng(0)
    for _ in range(20):
        def rows(m, n):
            dense = rng.integers(0, 3, (m, n)) * rng.integers(0, 2, (m, n))
            at = np.nonzero(dense)
            starts = np.concatenate(([0], np.cumsum((dense != 0).sum(axis=1))))
            return dense, alignment.Rows(starts, at[1], dense[at], n)

        def dense_of(r):
            out = np.zeros((len(r.starts) - 1, r.width), int)
            out[np.repeat(np.arange(len(out)), np.diff(r.starts)), r.col] = r.value
            return out

        m, k, n = rng.integers(1, 9, 3)
        (da, a), (db, b) = rows(m, k), rows(k, n)
        assert (dense_of(alignment.gustavson(a, b)) == da @ db).all()
        assert (dense_of(a.transposed()) == da.T).all()
        assert (alignment.flops(a, b) == ((da != 0).astype(int) @ (db != 0)).sum(axis=1)).all()


def test_group_links():
    at_a, at_b = alignment.group_links(np.array([2, 1]), np.array([1, 2]))
    assert list(zip(at_a.tolist(), at_b.tolist(), strict=True)) == [(0, 0), (1, 0), (2, 1), (2, 2)]
    assert alignment.group_link_counts(np.array([2, 1]), np.array([1, 2])).tolist() == [1, 1, 2]


def test_byte_bpe_gives_the_ids_of_the_tokenizers_library():
    """Every character of Unicode in several places, added tokens, long runs."""
    from tokenizers import Tokenizer

    fast, raw = byte_bpe.load(A)
    slow = Tokenizer.from_file(A)
    assert raw[slow.token_to_id("Ġthe")] == b" the"
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{c}b 1{c}2 !{c}? {c}{c} x \n{c} {c}'s" for c in chars]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|>\n\n<|endoftext|>x", "", "x" * 200_000,
              "x1-" * 40_000, " " * 100_000, "\n" * 3000 + "a", "a  b \t\td \n e", "é" * 50_000]
    for i in range(0, len(texts), 1 << 16):
        some = texts[i:i + (1 << 16)]
        for t, e in zip(some, slow.encode_batch_fast(some, add_special_tokens=False), strict=True):
            assert fast.encode(t, allowed_special="all") == e.ids


def test_group_links_are_made_by_the_product(monkeypatch):
    rng = np.random.default_rng(5)
    made = []
    product = alignment.gustavson
    monkeypatch.setattr(alignment, "gustavson", lambda a, b: made.append(product(a, b)) or made[-1])
    for block in (1, 7, 1000):
        a_in, b_in = rng.integers(1, 6, 40), rng.integers(1, 6, 40)
        made.clear()
        counts = alignment.group_link_counts(a_in, b_in, block)
        assert counts.tolist() == np.repeat(b_in, a_in).tolist()
        assert sum(len(m.col) for m in made) == int((a_in * b_in).sum())
        assert all(len(m.col) <= max(block, 5) for m in made)
    assert alignment.group_link_counts(np.array([], int), np.array([], int)).tolist() == []
