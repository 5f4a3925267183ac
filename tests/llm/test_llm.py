"""Operators on training data against brute force, reference libraries, planted cases and held-out rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from musterline.llm import (
    ann_prefix_forest,
    byte_bpe,
    components,
    decontamination,
    language_id,
    license_scan,
    ngram_jaccard_join,
    pii,
    quality_classifier,
    toxicity,
    warc,
)

ODD = [None, "", " \n\t", "one", "one two", "x " * 5000, "Éa 中文 🎉 don't stop", "+1 (555) 123-4567 a@b.co", "'s  \n\n 12"]


@pytest.fixture(scope="module")
def folder():
    return "/root/testdata/sf0.001"


def odd_docs(spark):
    """Nulls, empty, long, repeated rows, a null key, and an extra column with a clashing name."""
    rows = [(i, t, 1.0) for i, t in enumerate(ODD)] + [(3, "one", 1.0), (None, "one two three", 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, score double")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))


def shingles(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components_of(sets, num, den):
    parent = {d: d for d in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            shared = len(sets[a] & sets[b])
            if shared and den * shared >= num * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


@pytest.mark.parametrize(("k", "num", "den"), [(3, 9, 10), (5, 4, 5)])
def test_jaccard_join_is_exact(spark, k, num, den):
    rng = random.Random(k)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = []
    for length in (4, 9, 13, 22, 40, 90, 300):
        base = [rng.choice(vocabulary) for _ in range(length)]
        for edits in (0, 0, 1, 1, 2, 3, 5, 9):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [None, "", "One", "one"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_join.ngram_jaccard_components(df, k, num, den).collect()}
    sets = {i: shingles(t, k) for i, t in enumerate(texts)}
    expected = components_of(sets, num, den)
    assert got == {i: (len(sets[i]), expected[i]) for i in sets}


def test_jaccard_join_of_odd_and_empty_tables(spark):
    got = ngram_jaccard_join.ngram_jaccard_components(odd_docs(spark), 3, 9, 10).collect()
    assert len(got) == len(ODD) + 2
    assert {r.component_id for r in got if r.doc_id is None} == {None}
    assert ngram_jaccard_join.ngram_jaccard_components(odd_docs(spark).limit(0), 3, 9, 10).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}


def test_decontamination_finds_exact_and_near_copies_only(spark):
    rng = random.Random(3)
    items = [[f"i{rng.randrange(400)}" for _ in range(n)] for n in (3, 15, 30, 60, 60)]
    noise = lambda n: [f"n{rng.randrange(900)}" for _ in range(n)]
    docs, expected = [], set()
    for i, item in enumerate(items):
        edited = list(item)
        edited[len(item) // 2] = "edited"
        for text in (item, edited):
            doc = len(docs)
            docs.append((doc, " ".join([*noise(20), *text, *noise(20)])))
            n = len(item)
            held = {tuple(text[j : j + 5]) for j in range(n - 4)} if n >= 5 else {tuple(text)}
            wanted = [tuple(item[j : j + 5]) for j in range(n - 4)] if n >= 5 else [tuple(item)]
            if sum(s in held for s in wanted) >= 0.8 * len(wanted):
                expected.add((doc, i))
        docs.append((len(docs), " ".join([*noise(20), *item[: len(item) // 2], *noise(20)])))
    docs += [(1000 + i, t) for i, t in enumerate(ODD)]
    bench = [(i, " ".join(t)) for i, t in enumerate(items)] + [(98, None), (99, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(df, benchmark).collect()}
    # Shingles of this fixture differ between items, so all weigh the same.
    assert got == expected
    assert decontamination.contaminated(df.limit(0), benchmark).count() == 0
    assert decontamination.contaminated(df, benchmark.limit(0)).count() == 0


def test_decontamination_finds_cut_and_run_edited_passages(spark):
    rng = random.Random(5)
    items = [[f"i{rng.randrange(10**6)}" for _ in range(n)] for n in (15, 30, 50, 50, 80, 120, 120)]
    noise = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
    docs, expected = [], set()
    for i, item in enumerate(items):
        n = len(item)
        for run in (n // 12, (n - 4) // 5 - 4, (n - 4) // 5, (n - 4) // 5 + 1):
            for at in (0, n // 2, n - run) if run > 0 else ():
                text = [*item[:at], *noise(run), *item[at + run :]]
                held = sum(text[j : j + 5] == item[j : j + 5] for j in range(n - 4))
                if held >= 0.8 * (n - 4):
                    expected.add((len(docs), i, 20))
                docs.append((len(docs), " ".join([*noise(20), *text, *noise(20)])))
    bench = [(i, " ".join(t)) for i, t in enumerate(items)]
    df, benchmark = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.start) for r in decontamination.contaminated(df, benchmark).collect()}
    assert got == expected and len(expected) > 40


def best_windows(docs, bench):
    """The largest similarity over all windows, by the definition."""
    def grams(w, g):
        return Counter(" ".join(w[i : i + g]) for i in range(len(w) - g + 1)) if len(w) >= g else Counter([" ".join(w)])

    def cut(t):
        return [w for w in re.split(r"[^\w]|_", t.lower()) if w]

    items = {k: cut(t) for k, t in bench}
    size = {k: min(5, len(w)) for k, w in items.items()}
    spread = Counter(g for k, w in items.items() for g in grams(w, size[k]))
    weight = {g: 1 + math.log(len(items) / n) for g, n in spread.items()}
    found = {}
    for d, text in docs:
        w = cut(text)
        for k, iw in items.items():
            wanted, n = grams(iw, size[k]), len(iw)
            whole = sum(weight[g] * c for g, c in wanted.items())
            for start in range(max(1, len(w) - n + 1)):
                held = grams(w[start : start + n], size[k])
                share = round(sum(weight[g] * min(c, held[g]) for g, c in wanted.items() if g in held) / whole, 9)
                if share >= 0.8 and share > found.get((d, k), 0):
                    found[d, k] = share
    return found


def test_decontamination_tries_all_windows(spark):
    """Items that share an opening and a closing and repeat shingles; words inserted, moved and left out."""
    rng = random.Random(11)
    word = lambda n: [f"w{rng.randrange(n)}" for _ in range(n)]
    opening, closing = word(5), word(5)
    items = [[*opening, *word(rng.randrange(8, 30)), *closing] for _ in range(40)]
    items += [["again"] * 9 + word(6), ["x", "y"] * 8, word(3), word(1)]
    docs = []
    for item in items:
        for inserted in (0, 1, 2, 3):
            text = list(item)
            for _ in range(inserted):
                text.insert(rng.choice([5, len(text) - 5, rng.randrange(len(text))]) if len(text) > 10 else 0, "extra")
            docs.append([*word(rng.randrange(12)), *text, *word(rng.randrange(12))])
        docs.append([*item[2:], *word(4)])
        docs.append(item[: -2 or None])
    docs.append(opening * 400)
    docs = [(i, " ".join(d)) for i, d in enumerate(docs)]
    bench = [(i, " ".join(t)) for i, t in enumerate(items)]
    df = spark.createDataFrame([(*d, 1) for d in docs + docs[:9]], "doc_id long, text string, n int")
    found = decontamination.contaminated(df, spark.createDataFrame([(*b, 1.0) for b in bench], "item_id long, text string, weight double"))
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in found.collect()}
    expected = best_windows(docs, bench)
    assert got.keys() == expected.keys() and all(abs(got[k] - expected[k]) < 2e-9 for k in got)
    assert sum(0.8 <= s < 0.9 for s in expected.values()) > 10


def test_fingerprints_within_the_radius_are_all_found(spark):
    from pyspark.sql import functions as F

    rng = random.Random(2)
    items = [rng.getrandbits(63) for _ in range(20)]
    near = [(i * 100 + k, items[i] ^ sum(1 << b for b in rng.sample(range(63), k)), 7) for i in range(20) for k in range(0, 30)]
    left = spark.createDataFrame(near, "w long, print long, n int")
    right = spark.createDataFrame([(i, p, 7) for i, p in enumerate(items)], "item long, item_print long, n int")
    found = {(r["w"], r["item"]) for r in decontamination.within_radius(left, right).collect()}
    assert found == {(w, i) for w, p, _ in near for i, q in enumerate(items) if (p ^ q).bit_count() <= decontamination.RADIUS}
    assert decontamination.within_radius(left.withColumn("n", F.lit(8)), right).count() == 0


def test_decontamination_runs_no_python(spark, folder):
    df = decontamination.op2_benchmark_decontamination(spark, folder)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_bpe_equals_the_library_and_round_trips(spark):
    tiktoken, vocabulary = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    ranks = byte_bpe.load_ranks(spark, vocabulary.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=vocabulary.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    texts = ["".join(rng.choice("abxXéü中🎉\n\t12'’st   \x1f") for _ in range(rng.randrange(80))) for _ in range(300)]
    texts += [t for t in ODD if t] + ["a" * 3000, "ab" * 31, "the " * 4000, "<|endoftext|>"]
    df = spark.createDataFrame([*enumerate(texts), (-1, None)], "doc_id long, text string")
    for row in byte_bpe.encoded_and_decoded(spark, df).collect():
        ids = library.encode_ordinary(row.text or "")
        assert list(row.ids) == ids and row.n_tokens == len(ids)
        assert bytes(row.decoded) == (row.text or "").encode()
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert byte_bpe.encoded_and_decoded(spark, df.limit(0)).count() == 0
    encoder = byte_bpe.Encoder(ranks, vocabulary.PATTERN)
    assert all(encoder.merge(t.encode()) == list(encoder.merge_all([t.encode()])[0]) for t in ("thblehe", "ab" * 20, "çé", "x" * 70))


def test_forest_recall_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((5000, 24))
    x[7] = x[3]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9000, None), (9001, [0.0] * 24), (9002, [float("nan")] * 24), (9003, [1.0, None]), (9004, [1.0, 2.0]), (None, [1.0] * 24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = df.where("vec_id % 50 = 0 or vec_id = 3")
    got = ann_prefix_forest.nearest(df, queries).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = 0
    for q, best in found.items():
        similarity = unit @ unit[q]
        similarity[q] = -9
        hits += len({v for v, _ in best.values()} & set(np.argsort(-similarity)[:5].tolist()))
        assert all(abs(s - similarity[v]) < 1e-12 for v, s in best.values()) and sorted(best) == [1, 2, 3, 4, 5]
    assert hits >= 0.9 * 5 * len(found) and len(found) == 101
    assert found[3][1][0] == 7
    assert ann_prefix_forest.nearest(df.limit(0), queries.limit(0)).count() == 0


def test_forest_of_extreme_vectors_ties_and_copies(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((60, 8))
    scale = [1.0, 1e200, 1e-200, 1e-300][:4]
    rows = [(i, (v * scale[i % 4]).tolist()) for i, v in enumerate(x)]
    rows += [(100 + i, rows[7][1]) for i in range(9)] + [(3, rows[3][1])]  # more equal neighbours than ranks; a repeated row
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann_prefix_forest.nearest(df, df.where("vec_id in (3, 7, 100)")).collect()
    assert all(np.isfinite(r.score) for r in got) and len(got) == 15
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == 100] == [7, 101, 102, 103, 104]
    unit = {i: np.array(v) / np.abs(v).max() for i, v in rows}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    best = sorted((-round(float(v @ unit[3]), 9), i) for i, v in unit.items() if i != 3)[:5]
    assert [i for _, i in best] == [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == 3]


def test_license_base_places_and_labels(spark):
    texts = ["Released under the MIT License. under the mit license", "Apache License, Version 2.0 cc-by-nc", *ODD, "licensed under the GNU General Public License, version 3"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan_licenses(df).collect()}
    for i, text in enumerate(texts):
        w, places = license_scan.words_of(text), []
        for phrase, label in license_scan.PHRASES:
            p = phrase.split()
            places += [(j, label) for j in range(len(w) - len(p) + 1) if w[j : j + len(p)] == p]
        r = got[i]
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert (r.first_word, r.last_word) == (min((p for p, _ in places), default=None), max((p for p, _ in places), default=None))
    assert got[len(texts) - 1].labels == "gpl-3"
    assert license_scan.scan_licenses(df.limit(0)).count() == 0


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_edited_license_bodies_align(spark):
    """Bodies with words replaced, inserted and left out, against the best alignment of the whole text."""
    rng = random.Random(12)
    rows, expected = [], {}
    for label, body in license_scan.BODIES:
        w = license_scan.words_of(body)
        for share in (0.0, 0.02, 0.04, 0.3, 0.5):
            text = list(w)
            for _ in range(int(share * len(w))):
                at = rng.randrange(len(text))
                kind = rng.randrange(3)
                text[at : at + (kind > 0)] = ["edited"] * (kind < 2)
            doc = [*(f"n{rng.randrange(999)}" for _ in range(50)), *text, *(f"n{rng.randrange(999)}" for _ in range(50))]
            covered = longest_common(doc, w) / len(w)
            if covered >= 0.92 or covered < 0.85:  # near the bound, the best span may be cut differently
                expected[len(rows)] = (label, covered >= 0.92, round(covered, 2))
                rows.append((len(rows), " ".join(doc)))
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (label, whole, covered) in expected.items():
        long = [s for s in got[i].spans if s["label"] == label and s["end"] - s["start"] > 45]
        assert bool(long) == whole, (label, covered, got[i].spans)
        if whole:
            assert label in got[i].labels.split(",") and abs(long[0]["covered"] - covered) < 0.03
    assert sum(whole for _, whole, _ in expected.values()) >= 15 and len(expected) - 15 >= 10


def test_licenses_of_rows_without_a_key_of_their_own(spark):
    rows = [(None, "under the mit license", 1), (5, "under the MIT license now", 2), (5, "Apache License version 2", 3), (5, "none", 4), (None, None, 5)]
    df = spark.createDataFrame(rows + rows[:1], "doc_id long, text string, n_words int")
    got = sorted((r.n_words, r.n_base, r.first_word, r.base_labels, r.doc_id) for r in license_scan.scan_licenses(df).collect() if r.n_words)
    assert got == [(1, 0, None, "", 5), (4, 1, 0, "apache-2", 5), (4, 1, 0, "mit", None), (4, 1, 0, "mit", None), (5, 1, 0, "mit", 5)]


def test_pii_base_spans_stay_and_texts_are_redacted(spark):
    text = "a.b@c.de and 4111 1111 1111 1111 or 10.0.0.255 +49 (30) 1234567 not 999.1.1.1 nor 4111111111111112"
    assert [text[a:b] for _, a, b in pii.base_spans(text)] == ["a.b@c.de", "10.0.0.255", "4111 1111 1111 1111", "+49 (30) 1234567"]
    df = spark.createDataFrame([(0, text), *[(i + 1, t) for i, t in enumerate(ODD)]], "doc_id long, text string")
    model = pii.fit_pii(df)
    found = {r.doc_id: r for r in pii.find_pii(df, model).collect()}
    for r in found.values():
        assert {tuple(s) for s in r.base} == set(pii.base_spans(r.text or "")) <= {tuple(s) for s in r.pii}
    clean = {r.doc_id: r.text for r in pii.redact(df, model).collect()}
    assert clean[0].startswith("[EMAIL] and [CARD] or [IP] [PHONE] not") and clean[1] is None and clean[4] == "one"
    assert pii.find_pii(df.limit(0), pii.fit_pii(df.limit(0))).count() == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    """The base rules as they are worded."""
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((kind, *m.span()))
    return found


def test_pii_base_rules_equal_the_plain_patterns():
    rng = random.Random(8)
    bits = ["a@b.c", "@", ".", "a", "-", "+", " ", "1", "25", "255", "256", "0", "007", "4111 1111 1111 1111", "5500-0000-0000-0004", "x@y", "é", "(", ")", "\n", "%_"]
    for _ in range(6000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 25)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_pii_long_runs_take_linear_time(spark):
    import time

    runs = ["a" * 10**6 + " x@y", "1" * 10**6, "1.2.3." + "4" * 10**6, "1." * 10**6, "." * 10**6, "@" * 10**6, "a@" * 10**6, "+1 " + " " * 10**6]
    runs += ["a[at]" * 200_000, "1 " * 10**6, "a@b." * 200_000 + "c", " (at) " * 100_000, "-" * 10**6, "a" * 10**6 + " [at] host [dot] org"]
    model = pii.Trees().fit(np.zeros((1, len(pii.features("1", "number", 0, 1)))), np.zeros(1)), [0.0] * 3
    for text in runs:
        started = time.perf_counter()
        pii.all_spans(text, model)
        assert time.perf_counter() - started < 20, (text[:20], time.perf_counter() - started)
    # Long names and endings are proposed whole.
    long = "n" * 90 + " [at] host [dot] " + "o" * 40
    assert ("email", 4, 4 + len(long)) in pii.proposals("see " + long)
    # Nothing of the number of digits stops a job.
    docs = spark.createDataFrame([(1, "1.2.3." + "4" * 5000), (2, "1.2.3.000000255"), (3, None)], "doc_id long, text string")
    found = {r["doc_id"]: len(r["base"]) for r in pii.find_pii(docs, pii.fit_pii(docs)).collect()}
    assert found == {1: 0, 2: 1, 3: 0}


def test_pii_finds_hidden_addresses(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghiklmnoprstu", k=rng.randint(4, 9)))
    rows = [(i, f"{word()} {word()} {word()}.{word()}@{word()}.org {word()} meet @ noon, look (at) this") for i in range(300)]
    model = pii.fit_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    for hidden in ("jo.smith [at] uni [dot] org", "maria (at) example.org", "maria @ example.org", "p.lee [at] mail.uni [dot] edu"):
        text = f"please write {hidden} about it, see you @ noon or look (at) this"
        assert [(k, text[a:b]) for k, a, b in pii.all_spans(text, model)[1]] == [("email", hidden)]


def test_pii_long_secrets_leave_no_rest(spark):
    rng = random.Random(4)
    key = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    rows = [(i, f"the token is {key(rng.randint(18, 300))} and internationalization {i}") for i in range(400)]
    model = pii.fit_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    for n in (128, 129, 143, 144, 500):
        # Also one that holds a card number.
        secrets = [key(n), f"{key(n)}a4111111111111111f{key(40)}"]
        texts = spark.createDataFrame([(i, f"the token is {s} and more") for i, s in enumerate(secrets)], "doc_id long, text string")
        for r in pii.redact(texts, model).collect():
            assert re.fullmatch(r"the token is (\[(SECRET|CARD)\])+ and more", r.text), r.text


def test_language_of_held_out_documents(spark, folder):
    got = language_id.op7_language_id(spark, folder).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.9 and all(0 <= r.score <= 1 for r in got)
    model = language_id.fit_languages(spark.read.parquet(f"{folder}/documents.parquet"))
    odd = {r.doc_id: r.lang_pred for r in language_id.identify_languages(odd_docs(spark), model).collect()}
    assert odd[0] == odd[1] == odd[2] == "und" and odd[3] != "und"
    none = language_id.fit_languages(odd_docs(spark).selectExpr("doc_id", "text", "cast(null as string) lang"))
    assert {r.lang_pred for r in language_id.identify_languages(odd_docs(spark), none).collect()} == {"und"}


def test_pii_copies_do_not_fill_the_sample(spark, monkeypatch):
    rng = random.Random(7)
    keys = ["".join(rng.choices("0123456789abcdef", k=30)) for _ in range(200)]
    keys.sort(key=lambda k: zlib.crc32(f"secretthe token is {k} ".encode()))
    copied = next(k for k in keys if zlib.crc32(f"secretthe token is {k} ".encode()) % 4)
    texts = [f"the token is {k} and internationalization {k}" for k in keys[keys.index(copied) :]]
    df = spark.createDataFrame(list(enumerate(texts + texts[:1] * 300)), "doc_id long, text string").repartition(8)
    monkeypatch.setattr(pii, "SAMPLE_SPANS", 80)
    assert pii.fit_pii(df)[1][2] <= 1


def test_every_language_is_learned(spark):
    # 300 languages: each has a word of its own, and the last ones have the fewest texts.
    rng = random.Random(6)
    own = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(300)]
    rows = [(1000 * j + i, f"{w} {w}", f"x{j:03}") for j, w in enumerate(own) for i in range(2 if j < 256 else 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit_languages(df)
    assert set(model[1]) == {f"x{j:03}" for j in range(300)}
    assert all(r.lang_pred == r.lang for r in language_id.identify_languages(df, model).collect())


def test_quality_agrees_with_gold_labels(spark):
    folder = "/root/testdata/sf0.01"
    rejected = {r.doc_id: r.rejected for r in quality_classifier.op8_quality_classifier(spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    bad = [rejected[r.doc_id] for r in labels if r.quality == 0]
    fine = [rejected[r.doc_id] for r in labels if r.quality == 1]
    assert np.mean(bad) > 0.85 and np.mean(fine) < 0.01
    odd = quality_classifier.score_quality(odd_docs(spark), quality_classifier.fit_quality(odd_docs(spark)), score="score")
    assert odd.count() == len(ODD) + 2 and odd.columns == ["doc_id", "text", "score"]
    assert not quality_classifier.fit_quality(odd_docs(spark).limit(0)).any()


@pytest.mark.parametrize(("abstains", "share"), [(0.01, 0.05), (0.03, 0.14), (0.08, 0.02), (0.2, 0.4)])
def test_quality_votes_of_other_rates(abstains, share):
    rng = np.random.default_rng(1)
    low = rng.random(40_000) < share
    said = np.zeros((len(low), len(quality_classifier.LABELLERS)), int)
    said[np.arange(len(low)), rng.integers(0, said.shape[1], len(low))] = low
    wrong = rng.random(said.shape) < 0.0005
    said[wrong], said[rng.random(said.shape) < abstains] = 1, 2
    patterns, at, rows = np.unique((said * 3 ** np.arange(said.shape[1])).sum(axis=1), return_inverse=True, return_counts=True)
    called = quality_classifier.expectation_maximisation(patterns, rows)[at] >= 0.5
    voted = (said == 1).any(axis=1)
    assert not called[~voted].any() and called[low & voted].all() and called[~low].mean() < 0.01


def test_toxicity_finds_planted_words(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(1200):
        w = [rng.choice(words) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            w[rng.randrange(40)] = "vile"
        rows.append((i, " ".join(w), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(docs.select("doc_id", "text"), docs.where("doc_id < 900").select("doc_id", "toxic"))
    scored = toxicity.score_toxicity(docs, model).where("doc_id >= 900").collect()
    assert all((r.score >= 0.5) == bool(r.toxic) for r in scored)
    odd = toxicity.score_toxicity(odd_docs(spark), model)
    assert odd.columns == ["doc_id", "text", "score"] and all(0 <= r.score <= 1 for r in odd.collect())
    empty = toxicity.fit_toxicity(docs.select("doc_id", "text").limit(0), docs.select("doc_id", "toxic").limit(0))
    assert {r.score for r in toxicity.score_toxicity(odd_docs(spark), empty).collect()} == {0.5}


def test_warc_round_trip_and_revisits(spark):
    big = "<p>é</p>" * 200
    rows = [(1, "http://a", big), (2, "http://b\r\nx", big), (3, "http://c", "small"), (4, None, "small"), (5, "u", None), (6, "u", "\r\n\r\n" * 400), (7, "u", ""), (None, "u", big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.archive_and_read(spark, df).collect()}
    assert len(got) == len(rows) and got[1].refers_to == 2 and got[1].record_type == "revisit"
    for page, _, html in rows:
        data = (html or "").encode()
        assert (got[page].payload_bytes, got[page].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert page == 1 or (got[page].record_type, got[page].refers_to) == ("response", None)
    assert warc.archive_and_read(spark, df.limit(0)).count() == 0


def test_a_part_of_an_index_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "PART", 4000)
    pages = spark.range(60).selectExpr("id as page_id", "concat('u', id) as url", "repeat(sha2(cast(id as string), 512), 9) as html")
    folder = f"{tmp_path}/archives"
    index = warc.write_archives(warc.plan_records(pages.repartition(3)), folder)
    chosen = index.where("key % 7 = 2")
    read = warc.read_archives(chosen, folder)
    assert {r["fields"]["WARC-Target-URI"] for r in read.collect()} == {f"u{i}" for i in range(60) if i % 7 == 2}
    assert warc.read_archives(index, folder).rdd.getNumPartitions() > 3
    assert warc.read_archives(index.limit(0), folder).count() == 0


def test_pipeline_stages_take_effect(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns, name
        now = {r.doc_id for r in docs.collect()}
        assert now <= kept
        if name == "benchmark_decontamination":
            found = decontamination.contaminated(before, spark.read.parquet(f"{folder}/benchmark.parquet"))
            assert kept - now == {r.doc_id for r in found.collect()}
        if name == "ngram_jaccard_join":
            sets = {r.doc_id: shingles(r.text, 5) for r in before.collect()}
            assert now == {d for d, c in components_of(sets, 4, 5).items() if d == c}
        kept = now
    assert not [r for r in docs.collect() if pii.base_spans(r.text)]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in last} == kept and all(r.round_trip for r in last)


def test_pipeline_stages_of_empty_and_odd_tables(spark, folder):
    import corpus_pipeline

    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(ODD)] + [(3, "one", "en", "s", 3), (None, "one two three", None, None, None)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").schema)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), folder)
        assert empty.count() == 0, name
        found = stage(spark, docs, folder)
        assert name == "byte_bpe" or (found.columns == docs.columns and empty.columns == docs.columns), name
        assert 0 < found.count() <= docs.count(), name


def test_pii_trees_learn_from_every_labelled_span(spark, monkeypatch):
    rng = random.Random(11)
    texts = [f"call +49 30 {rng.randrange(10**7):07d} or key {rng.randrange(16**20):020x} at x{i}@mail.example.org" for i in range(60)]
    texts += [f"note {rng.randrange(10**5)} and word{'x' * 16}{i}" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    trees, thresholds = pii.fit_pii(df)
    monkeypatch.setattr(pii, "SAMPLE_SPANS", 4)
    few, few_thresholds = pii.fit_pii(df)
    x = np.array([pii.features(t, *s) for t in texts for s in pii.proposals(t)])
    assert np.allclose(trees.predict(x), few.predict(x)) and thresholds == few_thresholds


def test_bpe_worker_keeps_no_pieces_after_a_task(spark):
    """A finished task leaves no remembered pieces in its worker, which may next serve other stages."""
    import pyarrow as pa

    vocabulary = pytest.importorskip("public_tokenizers")
    ranks = byte_bpe.load_ranks(spark, vocabulary.path("byte_bpe_50k.tiktoken"))
    encoded = byte_bpe._encoding(spark, ranks, vocabulary.PATTERN, "text", "ids")
    batch = pa.record_batch([pa.array(["some words and more words", None, "x " * 50])], names=["text"])
    out = list(encoded(iter([batch])))
    assert [len(x) > 0 for x in out[0].column("ids").to_pylist()] == [True, False, True]
    encoder = next(iter(byte_bpe._encoders.values()))
    assert encoder.known == {} and encoder.spaced == {} and encoder.held == 0


def test_jaccard_verification_shuffles_only_the_texts_of_candidates(spark, monkeypatch):
    """A small set of candidate keys is sent to the tasks even past Spark's broadcast threshold."""
    seen = []
    monkeypatch.setattr(ngram_jaccard_join, "sized", lambda df, *a: seen.append(df.count()) or decontamination.sized(df, *a))
    texts = ["a b c d e f g h i j", "a b c d e f g h i k", "p q r s t u v w x y"] + [f"w{i} v{i} u{i} t{i}" for i in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pairs = spark.createDataFrame([(0, 1), (0, 2)], "a long, b long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = ngram_jaccard_join._verified(pairs, docs, "doc_id", "text", 3, 7, 10).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [(r.a, r.b) for r in got] == [(0, 1)]
    assert seen == [3]
