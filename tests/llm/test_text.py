"""Language, packing, decontamination, toxicity, personal data, secrets and pages."""

import hashlib
import html
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakemart.llm import decontaminate, html_text, langid, packing, pii, secret_scan, toxicity
from lakemart.llm.common import held_out, shingle_set, word_hashes
from lakemart.llm.queries import tokenizer_path

from .conftest import SMALL


def fold(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


# --- hashing ------------------------------------------------------------------

def test_words_are_hashed_alike_in_pieces():
    words = [f"w{i % 5000}é" for i in range(400_000)]
    got = word_hashes(" ".join(words).encode())  # several pieces
    names = dict(zip(words, got, strict=True))
    assert got.size == len(words) and len(set(names.values())) == 5000
    assert (got == np.array([names[w] for w in words])).all()
    assert word_hashes(b" \t").size == 0 and shingle_set(None).size == 0
    assert shingle_set(b"one TWO").size == 1 and (shingle_set(b"one TWO") == shingle_set(b"One  two")).all()


# --- language -----------------------------------------------------------------

def test_language_held_out(documents, corpus):
    got = {r.doc_id: r for r in langid.language_rows(documents).collect()}
    assert len(got) == len(corpus) and all(r.held_out == fold(d) for d, r in got.items())
    right = [got[r.doc_id].lang_pred == r.lang for r in corpus if fold(r.doc_id)]
    assert sum(right) >= 0.98 * len(right)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_distance_is_the_plain_one(documents, corpus):
    profiles = langid.fit_profiles(documents, fit_rows=50)
    judge = langid._Distances(profiles, langid.PROFILE)
    for r in corpus[:40]:
        own = langid._ranked(langid._grams(r.text), langid.PROFILE).tolist()
        plain = {}
        for lang, p in profiles.items():
            rank = {g: n for n, g in enumerate(p.tolist())}
            plain[lang] = sum(abs(rank[g] - n) if g in rank else langid.PROFILE
                              for n, g in enumerate(own))
        best = min(sorted(plain), key=plain.get)
        assert judge.nearest(np.array(own)) == (
            best, pytest.approx(1 - plain[best] / (langid.PROFILE * len(own))))


def test_language_awkward(spark, awkward, no_docs):
    profiles = langid.fit_profiles(awkward)
    got = {r.doc_id: r for r in langid.identify(awkward, profiles).collect() if r.doc_id is not None}
    for i in (0, 1, 2, 3):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert got[4].lang_pred != "und"
    assert langid.identify(awkward, profiles).count() == awkward.count()
    assert langid.fit_profiles(no_docs) == {} and langid.language_rows(no_docs).count() == 0
    assert {r.lang_pred for r in langid.identify(awkward, {}).collect()} == {"und"}
    left = langid.keep_identified(awkward, profiles)
    assert left.columns == awkward.columns
    assert {r.doc_id for r in left.collect()} == {4, 5, 6, 7, 8, 9, 10, 11, 12, 13, None}


# --- packing ------------------------------------------------------------------

def check_pieces(df):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer_path())
    rows, pieces = df.collect(), packing.pack(df, tokenizer_path()).collect()
    want = Counter((r.doc_id, tuple(encoder.encode(r.text or "", add_special_tokens=False).ids) + (0,))
                   for r in rows)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for ps in by_sequence.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= packing.WINDOW
    ids_of = defaultdict(list)
    for (doc, ids), n in want.items():
        ids_of[doc] += [ids] * n
    for doc, docs in ids_of.items():  # repeated rows have pieces each
        left = Counter((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in by_doc.pop(doc))
        covered = Counter()
        for start, length, crc, n in left.elements():
            match = [d for d in docs if len(d) == n and zlib.crc32(
                np.array(d[start:start + length], "<u4").tobytes()) == crc]
            assert match
            covered.update(range(start, start + length))
        total = Counter()
        for d in docs:
            total.update(range(len(d)))
        assert covered == total
    assert not by_doc
    lengths = [sum(p.length for p in ps) for ps in by_sequence.values()]
    padding = sum(0 if n & (n - 1) == 0 else packing.WINDOW - n for n in lengths)
    return padding / max(1, sum(lengths))


def test_packing(documents):
    assert check_pieces(documents) < 0.02


def test_packing_awkward(awkward, no_docs):
    check_pieces(awkward)
    assert packing.pack(no_docs, tokenizer_path()).count() == 0


def test_packing_of_added_tokens(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext", "it's we'll  x\x1c y\x85 z\n\n a \n"]
    check_pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_tokenizing_is_exact(corpus):
    from tokenizers import Tokenizer

    encoder, mine = Tokenizer.from_file(tokenizer_path()), packing.TextTokenizer(tokenizer_path())
    texts = ["", " ", "a", " a  b ", "a\n b\t\tc", "it's we'll <|endoftext|> x", "é à ü  z", "a" * 5000,
             "x\x1c y\x85 z", "\n\n a \n", "1 22 333 4,5!? --  ...", "\U0001f600 ​ q", *(r.text for r in corpus)]
    for t in texts:
        want = encoder.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(mine.encode(t), "<u4").tolist() == want, repr(t)


def test_differencing():
    sums, items = packing.difference([8, 7, 6, 5, 4], 2)
    assert sorted(i for w in items for i in w) == list(range(5)) and sums.tolist() == [16, 14]
    # three items that do not fit two windows pairwise make a third
    assert len(packing.balanced([700, 700, 600], 2, 1024)) == 3


# --- decontamination ------------------------------------------------------------

def test_leaks(spark):
    import random

    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 7)))
    items = [[word() for _ in range(rng.randint(15, 60))] for _ in range(40)] + [["one", "two"]]
    docs, planted = [], {}
    for i in range(300):
        text = [word() for _ in range(rng.randint(5, 400))]
        if i % 3 == 0:
            n = rng.randrange(40)
            passage = list(items[n])
            if i % 2:  # one word in six is another
                for at in range(2, len(passage), 6):
                    passage[at] = word()
            at = rng.randrange(len(text))
            text[at:at] = [w.upper() + "," if i % 4 == 0 else w for w in passage]
            planted[i] = n
        if i % 3 == 1:  # a few words in common are no leak
            text[3:3] = items[i % 40][:8]
        docs.append((i, " ".join(text)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in enumerate(items)],
                                  "item_id long, text string")
    for block in (decontaminate.BLOCK_WORDS, 300):
        got = decontaminate.find_leaks(df, bench, block_words=block).collect()
        assert {r.doc_id: r.item_id for r in got} == planted
        assert all(r.agreeing >= 0.75 * r.n_words for r in got)
    left = {r.doc_id for r in decontaminate.drop_leaks(df, bench).collect()}
    assert left == set(range(300)) - set(planted)


def test_leaks_awkward(spark, awkward, no_docs):
    bench = spark.createDataFrame([(1, None), (2, ""), (None, "no id but some words in here"),
                                   (3, "a tie of FIVE words here"), (4, "three"), (5, "a tie of five words here")],
                                  "item_id long, text string")
    got = decontaminate.find_leaks(awkward, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(d, i) for d in (9, 10) for i in (3, 5)}
    assert decontaminate.find_leaks(no_docs, bench).count() == 0
    none = bench.where("false")
    assert decontaminate.find_leaks(awkward, none).count() == 0
    left = decontaminate.drop_leaks(awkward, bench)
    assert left.columns == awkward.columns and left.count() == awkward.count() - 4
    assert decontaminate.drop_leaks(awkward, none).count() == awkward.count()


# --- toxicity -------------------------------------------------------------------

def test_segments_of_falling_scores():
    """Sums that fall all the way and a million of words: each kept segment is passed once."""
    n = 500_000
    assert toxicity.segments([0.5, -1.0] * n) == [(2 * i, 2 * i + 1, 0.5) for i in range(n)]
    rising = toxicity.segments([1.0, -0.5] * n)
    assert rising == [(0, 2 * n - 1, 0.5 * (n + 1))]


def test_segments_are_the_maximal_ones():
    import random

    rng = random.Random(2)

    def brute(scores, lo, hi):
        """The best segment (shortest, leftmost), then those left and right of it."""
        best = None
        for i in range(lo, hi):
            s = 0
            for j in range(i, hi):
                s += scores[j]
                if s > 0 and (best is None or s > best[2] or s == best[2] and j + 1 - i < best[1] - best[0]):
                    best = (i, j + 1, s)
        return [] if best is None else brute(scores, lo, best[0]) + [best] + brute(scores, best[1], hi)

    for _ in range(200):
        scores = [rng.choice([-5, -3, -2, -1, 1, 2, 3, 4]) + rng.random() / 64 for _ in range(rng.randint(0, 25))]
        got = toxicity.segments(scores)
        want = brute(scores, 0, len(scores))
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(8, "doc_id")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = {r.doc_id: r for r in toxicity.toxicity_rows(docs, labels).collect()}
    assert all(r.held_out == fold(d) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
               for d, r in got.items())
    judged = [(got[r.doc_id].predicted, r.toxic) for r in labels.collect() if fold(r.doc_id)]
    toxic = [p for p, t in judged if t]
    assert np.mean([p == t for p, t in judged]) >= 0.96 and np.mean(toxic) >= 0.75


def test_toxicity_awkward(spark, awkward, no_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1), (3, None), (5, 7)],
                                   "doc_id long, toxic int")
    for table, used in ((awkward, labels), (awkward, labels.where("false")), (no_docs, labels),
                        (awkward, labels.where("toxic = 1"))):
        got = toxicity.toxicity_rows(table, used).collect()
        assert len(got) == table.count() and all(0 <= r.score <= 1 for r in got)


# --- personal data --------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 14 <= len(d) <= 19 and luhn(d)
                    or kind == "phone" and 10 <= len(d) <= 15):
                out.append((m.start(), n, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def check_base(df):
    rows, got = df.collect(), pii.personal_data_rows(df).collect()

    def facts(doc_id, spans):
        return (doc_id, *(sum(s.startswith(k) for s in spans) for k in PATTERNS),
                hashlib.sha256(",".join(spans).encode()).hexdigest())

    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == \
        Counter(facts(r.doc_id, base_spans(r.text)) for r in rows)
    by_id = defaultdict(set)
    for r in rows:
        by_id[r.doc_id].add(",".join(base_spans(r.text)))
    assert all(",".join(s for s in r.spans.split(",") if not s.startswith("id:")) in by_id[r.doc_id]
               for r in got)
    return got


def test_personal_data(documents):
    check_base(documents)


def test_personal_data_awkward(spark, awkward, no_docs):
    check_base(awkward)
    assert pii.personal_data_rows(no_docs).count() == 0
    tricky = ["a@b.co_x@c.de a@b.c@d.e", "é\U0001f600 x@y.z 1.2.3.4.5.6.7.8 256.1.1.1 001.002.3.4",
              "1" * 5000, "1 " * 9000, "4111 1111 1111 1111 4111-1111-1111-1111  5500000000000004-",
              "+1 (017) 555-7713 +12 3 +1 222 333 4444 5555 6666 +", "a" * 20000 + "@", ".@-.-.-@x.y",
              "a.b@" * 3000, "1.2.3." * 3000, "x@y.z" * 500, "\n1.1.1.1\r2.2.2.2 +1234567890123"]
    check_base(spark.createDataFrame(list(enumerate(tricky)), "doc_id long, text string"))


def test_many_spans_in_one_text(spark):
    """Spans of one text are merged in order, not paired: 30,000 addresses and as many numbers."""
    text = " ".join(f"u{i}@mail.example ref {1000 + i}" for i in range(30_000))
    check_base(spark.createDataFrame([(1, text), (2, "a@b.co")], "doc_id long, text string"))


@pytest.mark.parametrize("seed", range(4))
def test_seeds_are_the_overlapping_candidates(spark, seed):
    import random

    rng = random.Random(seed)

    def some(n):
        return [(rng.randrange(3), s, s + rng.randrange(1, 9)) for s in rng.choices(range(60), k=n)]

    cands, base = sorted(set(some(40))), some(12)
    got = pii._seeds(
        spark.createDataFrame([(*c, "", "", "", False) for c in cands],
                              "row long, start long, end long, before string, after string, "
                              "instance string, base boolean"),
        spark.createDataFrame(base, "row long, start long, end long")).collect()
    assert sorted((r.row, r.start, r.end, r.seed) for r in got) == [
        (row, s, e, any(b == row and x < e and s < y for b, x, y in base)) for row, s, e in cands]


def test_contexts_find_unseen_identifiers(spark):
    """An account number that no pattern matches, in the words that stand before known ones."""
    rows = [(i, f"Some words. Please reach owner contact: u{i}@mail.example and go on, word{i}.")
            for i in range(30)]
    rows += [(100 + i, f"Some words. Please reach owner contact: AB-{i}-77{i}31X and go on, word{i}.")
             for i in range(4)]
    rows += [(200 + i, f"A plain part number 5{i}5{i}55 is not one.") for i in range(20)]
    got = {r.doc_id: r.spans for r in pii.personal_data_rows(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        if 100 <= i < 200:
            start = text.index("AB-")
            assert got[i] == f"id:{start}:{text.index(' and go')}"
        elif i >= 200:
            assert got[i] == ""


def test_personal_data_is_native(documents):
    plan = pii.personal_data_rows(documents.limit(20))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- secrets --------------------------------------------------------------------

def test_secrets(documents, corpus):
    got = secret_scan.scan(documents).collect()
    text = {r.doc_id: r.text for r in corpus}
    assert all(text[r.doc_id][r.start:r.end] == r.value for r in got)
    found = {(r.doc_id, r.value) for r in got if r.secret}
    planted = {(d, m[1]) for d, t in text.items() for m in re.finditer(r'token = "([0-9a-f]{40})"', t)}
    assert planted and planted == found


def test_secrets_learn_from_findings(spark):
    """Labels of the caller decide: here long hexadecimal strings are false positives."""
    import random

    rng = random.Random(4)
    rows, known = [], []
    for i in range(200):
        hexa = i % 2 == 0
        value = "".join(rng.choices("0123456789abcdef" if hexa else "ABCDEFGHJKLMNPQRSTUVWXYZ23456789", k=32))
        rows.append((i, f"set it to {value} now", f"src{i % 3}"))
        if i < 150:
            known.append((i, 10, 42, 0 if hexa else 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame(known, "doc_id long, start int, end int, label int")
    got = {r.doc_id: r.secret for r in secret_scan.scan(docs, labels).collect()}
    assert len(got) == 200 and all(got[i] == (i % 2 == 1) for i in range(150, 200))


def test_short_and_punctuated_secrets(spark):
    """Assigned values of any length and marks are candidates, and are told from prose and numbers."""
    import random

    rng = random.Random(7)
    lines = ['password = "hunter2x9"', 'pwd="Tr0ub4dor"', 'db_password: "P@ssw0rd!2024#xyzzy"',
             'secret = "correcthorsebatterystaple"', "'api-key' => 'a b!c?d9$e'",
             '{"passwd":x9!k}', 'token: str = "q7;W-r"', 'auth = "ghp_' + "a1B2" * 9 + '"']
    values = ["hunter2x9", "Tr0ub4dor", "P@ssw0rd!2024#xyzzy", "correcthorsebatterystaple",
              "a b!c?d9$e", "x9!k", "q7;W-r", "ghp_" + "a1B2" * 9]
    for line, value in zip(lines, values, strict=True):
        found = secret_scan.candidates(line)
        assert [v for _, v, _ in found] == ["str"] * ("str =" in line) + [value]
        assert all(line[a:a + len(v)] == v for a, v, _ in found)
    assert not secret_scan.candidates("The author: nobody. A = b, time: 12:30, no == yes")
    words = "the house and river stand under green hills while people walk home".split()
    rows = []
    for i in range(240):
        prose = " ".join(rng.choices(words, k=12))
        value = "".join(rng.choices("abcdefghjkmnpqrstuvwxyz23456789!#$%", k=rng.randint(8, 14)))
        rows.append((i, f'{prose} password = "{value}" {prose}' if i % 2 else
                     f"{prose} password: {rng.choice(words)} {prose}", "s"))
    rows += [(1000 + i, f"{words[i]} {x} {words[i]}", "s") for i, x in enumerate(lines[:4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in secret_scan.scan(docs).collect()}
    assert all(got[i].secret == bool(i % 2) for i in range(240))
    assert [(got[1000 + i].value, got[1000 + i].secret) for i in range(4)] == [(v, True) for v in values[:4]]


def test_secret_statistics_cover_all_texts(spark, monkeypatch):
    """Words of single texts among many copies count, and copies don't enter the fit as one."""
    import math

    monkeypatch.setattr(secret_scan, "TASK_WORDS", 3)
    rare = [f"rare{chr(97 + i)}{chr(97 + i)}z" for i in range(20)]
    docs = spark.createDataFrame([(x,) for x in rare], "text string").unionByName(
        spark.range(60_000).selectExpr("'ox hill' as text"))
    table, known = secret_scan._language(docs)
    assert known == {"hill", *rare}
    after_i = 60_000 + 2 + 0.5 * 96  # pairs of hill, rareiiz, and the prior
    assert math.isclose(table[ord("i") - 32, ord("l") - 32], math.log(60_000.5 / after_i))
    labelled = spark.range(4000).selectExpr(
        "id", "0 as start", "if(id % 2 = 0, 'one copy', 'another') as value", "int(id % 2) as label",
        "transform(sequence(1, 21), x -> double(id % 2)) as features")
    drawn = []
    monkeypatch.setattr(secret_scan, "stage", lambda df, name: drawn.append(df.cache()) or drawn[-1])
    assert secret_scan._fit(labelled, 200) is not None
    n = {r.label: r["count"] for r in drawn[0].groupBy("label").count().collect()}
    assert all(120 < n[x] < 280 for x in (0.0, 1.0))


def test_secrets_awkward(awkward, no_docs):
    got = secret_scan.scan(awkward).collect()
    assert {r.doc_id for r in got} <= {4, 5, 6}
    assert secret_scan.scan(no_docs).count() == 0


# --- pages ----------------------------------------------------------------------

def test_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").repartition(4)
    got = {r.page_id: r for r in html_text.main_text(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", lambda m: " " if m[0] == "<br>" else "", x))
                           .split()) for x in re.split(r"</?(?:h1|p)>", article)]
        assert got[r.page_id].text == "\n".join(b for b in blocks if b)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def test_shared_lines_go(spark):
    """Without telling markup the neighbour tells furniture from text; a copy tells nothing."""
    def page(i, body):
        return (f"<body><div>Our site</div><table><tr><td>Home<td>News</table>{body}"
                f"<div>All rights reserved</div><p>Printed on {i}")

    rows = [(i, f"http://h.example/a/{i}.html?x={i}", page(i, f"<p>Story {i} has <b>its</b> own&nbsp;text.<p>More {i}"))
            for i in range(20)]
    rows += [(50, "http://h.example/a/7", rows[7][2]), (60, "http://alone.example/x", page(60, "<p>Alone."))]
    got = {r.page_id: r.text for r in html_text.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    for i in range(20):
        assert got[i] == f"Story {i} has its own text.\nMore {i}\nPrinted on {i}"
    assert got[50] == got[7]
    assert got[60].startswith("Our site\nHome\nNews\nAlone.")


def test_markup(spark):
    source = ("<!doctype html><html><head><title>T</title><style>p{}</style></head><body class='no-sidebar'>"
              "<!-- a > b --><header>Top</header><nav>Menu<div class=ad>Buy<article><header><h1>Head &amp; &lt;x&gt;</h1></header>"
              "<p>One<br>two  <i>th</i>ree a < b &#233;<p class='ad-slot wide'>Ad</p><div id=\"cookie-notice\">C</div>"
              "<ul><li>x<li>y</ul><script>if (a</p>b) '<p>no</p>'</script><form>F<input></form></article>"
              "<section class='comments'><article><p>Reader</p></article></section><footer>&copy;</footer>")
    page = html_text.parse(source)
    keep = [t for t, f, a in zip(page.lines, page.furniture, page.article, strict=True) if a and not f]
    assert keep == ["Head & <x>", "One two three a < b é", "x", "y"]
    assert html_text.parse(None).lines == [] and html_text.parse("<p").lines == []
    assert html_text.parse("plain <b>text").lines == ["plain text"]


def test_names_hide_blocks_and_values_do_not():
    shown = ['<p title="a hidden gem">Body</p>', '<section id="related-work"><p>Body</p></section>',
             '<div id="search-trees">Body</div>', '<p data-x="class=ad">Body</p>',
             '<p data-style="display:none">Body</p>', '<p aria-hidden="false">Body</p>']
    gone = ['<p hidden>Body</p>', '<p class="a" hidden=hidden>Body</p>', "<p aria-hidden='true'>Body</p>",
            '<p style="color:red; display: none">Body</p>', '<div id="cookie-notice">Body</div>',
            '<div class="related-work">Body</div>', '<div id=sidebar>Body</div>']
    for markup, furniture in [(x, False) for x in shown] + [(x, True) for x in gone]:
        assert html_text.parse(f"<article>{markup}</article>").furniture == [furniture], markup
    # outside an article an id counts as before
    assert html_text.parse('<div id="related-posts">Body</div>').furniture == [True]


@pytest.mark.parametrize("a, b, length", [
    ([7] * 100_000, [7] * 99_000, 99_000),
    ([7] * 100_000 + [1], [1] + [7] * 100_000, 100_000),
    ([1, 2] * 25_000, [2, 2, 1] * 15_000, None)])
def test_common_lines_of_many_equal_lines(a, b, length):
    start = time.monotonic()
    got = html_text.common_lines(a, b)
    assert time.monotonic() - start < 30  # every agreeing pair of positions by itself would take hours
    assert got == sorted(set(got)) and (length is None or len(got) == length)
    rest = iter(b)
    assert all(any(x == y for y in rest) for x in (a[i] for i in got))


@pytest.mark.parametrize("pairs_a_line", [1, html_text.PAIRS_A_LINE])
def test_common_lines(monkeypatch, pairs_a_line):
    import random

    monkeypatch.setattr(html_text, "PAIRS_A_LINE", pairs_a_line)
    rng = random.Random(6)
    for _ in range(100):
        a = [rng.randrange(6) for _ in range(rng.randint(0, 14))]
        b = [rng.randrange(6) for _ in range(rng.randint(0, 14))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        got = html_text.common_lines(a, b)
        assert len(got) == best[-1][-1] and got == sorted(set(got))
        rest = iter(b)
        assert all(any(x == y for y in rest) for x in (a[i] for i in got))


def test_pages_awkward(spark):
    rows = [(1, None, None), (1, None, None), (None, "", ""), (2, "http://h/x", None), (3, "http://h/x", "<p>One"),
            (3, "http://h/x", "<p>One"), (4, "not a url", "<div>" * 5000 + "deep"), (5, "http://h/y", "<a " * 5000),
            (6, "http://h/z", "<p>" + "long " * 50_000)]
    df = spark.createDataFrame([(*r, "k", "g") for r in rows],
                               "page_id long, url string, html string, key string, gone string")
    got = html_text.main_text(df).collect()
    assert Counter(r.page_id for r in got) == Counter(r[0] for r in rows)
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[2] == by[None] == "" and by[3] == "One" and by[4] == "deep"
    assert by[6] == " ".join(["long"] * 50_000)
    assert html_text.main_text(df.where("false")).count() == 0


def test_held_out(spark):
    rows = spark.range(50).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == fold(r.id) for r in rows)
