"""Lexical search, Merkle manifest and piece BPE against brute force and the reference library."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from musterline.llm import lexical_search, merkle_manifest, piece_bpe

ODD = [None, "", " \n\t", "one", "one two", "x " * 5000, "Éa 中文 🎉 don't stop", "ONE one Two", "y" * 20_000]


# --- ranked lexical search ---


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def ranked(docs, items, best=20):
    of = [(k, Counter(terms(t))) for k, t in docs]
    total = sum(sum(c.values()) for _, c in of)
    n_docs = sum(1 for _, c in of if c)
    df = Counter(t for _, c in of for t in c)
    out, asked = [], {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, Counter()).update(terms(text))
    for item, wanted in asked.items():
        scores = []
        for k, c in of:
            m = 75 + 25 * sum(c.values()) * n_docs // max(total, 1)
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                for t, times in wanted.items() if c[t]
            )
            if score > 0:
                scores.append((-score, k is None, k or 0, k))
        out += [(item, i + 1, k, -s) for i, (s, _, _, k) in enumerate(sorted(scores)[:best])]
    return sorted(out, key=lambda r: r[:2])


def searched(spark, docs, items, **settings):
    d = spark.createDataFrame([(k, t, "x", 1.0) for k, t in docs], "doc_id long, text string, term string, score double")
    b = spark.createDataFrame([(k, t, 2) for k, t in items], "item_id long, text string, rank int")
    found = lexical_search.ranked_search(d, b, **settings)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=lambda r: r[:2])


def test_search_equals_brute_force_with_ties_and_copies(spark, monkeypatch):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(90)] + ["É", "中", "UPPER"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60))) for _ in range(300)]
    docs = list(enumerate(texts + texts[:80] + ODD)) + [(7, texts[7]), (None, texts[9]), (None, "w1 w2")]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 40)))) for i in range(30)]
    items += [(3, "w5 w5 w5"), (None, "w1"), (40, None), (41, ""), (42, "nowhere"), (43, "one ONE two"), (44, "w1 " * 700)]
    expected = ranked(docs, items)
    assert searched(spark, docs, items) == expected
    # The same in small tiles, cut products and several passes.
    monkeypatch.setattr(lexical_search, "CELLS", 1 << 8)
    monkeypatch.setattr(lexical_search, "DOCS", 7)
    monkeypatch.setattr(lexical_search, "ITEMS", 4)
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", 2000)
    assert searched(spark, docs, items) == expected


def test_products_stay_exact_beyond_float64():
    rng = np.random.default_rng(1)
    weights, impacts = rng.integers(0, 1 << 31, (5, 40)), rng.integers(0, 1 << 20, (40, 6))
    assert (lexical_search._products(weights, impacts) == weights @ impacts).all()
    # A sum that float64 cannot hold: one part alone is odd and above 2^53.
    weights = np.array([[1 << 32, 1 << 32, 1]])
    impacts = np.array([[1 << 20], [1 << 20], [1]])
    assert lexical_search._products(weights, impacts)[0, 0] == (1 << 53) + 1


def test_search_of_empty_tables(spark):
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, [(1, "a")], []) == []
    assert searched(spark, [(1, None), (2, "")], [(1, "a")]) == []


# --- Merkle manifest ---


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def proofs(rows):
    def lowered(t):
        return t and re.sub("[A-Z]", lambda m: m.group().lower(), t)

    def levels(digests):
        built = [digests]
        while len(built[-1]) > 1:
            built.append([sha(*built[-1][i : i + 16]) for i in range(0, len(built[-1]), 16)])
        return built

    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0], leaf_of(row), leaf_of((*row[:4], lowered(row[4])))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {name: levels([x[1] for x in groups[name]]) for name in names}
    top = levels([trees[name][-1][0] for name in names])
    out = []
    for g, name in enumerate(names):
        for i, (key, leaf, changed) in enumerate(groups[name]):
            folded = changed if key is not None and zlib.crc32(str(key).encode()) % 5 == 0 else leaf
            siblings = []
            for tree, at in ((trees[name], i), (top, g)):
                for level in tree[:-1]:
                    run, place = level[at // 16 * 16 : at // 16 * 16 + 16], at % 16
                    siblings += run[:place] + run[place + 1 :]
                    folded, at = sha(*run[:place], folded, *run[place + 1 :]), at // 16
            root = top[-1][0]
            out.append((key, leaf, trees[name][-1][0], root, sha(*siblings), folded, folded == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("case", ["many", "one", "one source", "empty"])
def test_manifest_equals_brute_force(spark, monkeypatch, case):
    rng = random.Random(4)
    monkeypatch.setattr(merkle_manifest, "BLOCK", 256)
    rows = [
        (i if i % 17 else None, rng.choice([None, "é", "a", "a", "a", "b", f"s{i % 40}"]), rng.choice(["en", None]),
         rng.choice([None, i]), rng.choice([None, "", "Abc É ", "X" * 50_000 if i == 5 else "Xy"]))
        for i in range(900)
    ]
    rows = {"many": rows + rows[:30], "one": rows[:1], "one source": [(r[0], "s", *r[2:]) for r in rows[:17]], "empty": []}[case]
    docs = spark.createDataFrame(
        [(*r, 1, "x", 2) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, rank int, parent string, n int"
    )
    found = merkle_manifest.verified_documents(docs)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == (proofs(rows) if rows else [])


def test_a_changed_digest_is_found_below_any_node(spark):
    from pyspark.sql import functions as F

    leaves = spark.range(300).select(
        F.col("id").alias("key"), (F.col("id") % 3).cast("string").alias("part"), F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256)).alias("digest")
    )
    manifest = merkle_manifest.build_manifest(leaves, "part", "key")
    lie = F.when(F.col("key") == 77, F.unhex(F.lit("00" * 32))).otherwise(F.col("digest"))
    from dataclasses import replace

    rows = merkle_manifest.climb(replace(manifest, leaves=manifest.leaves.withColumn("claimed", lie))).collect()
    wrong = [r["key"] for r in rows if bytes(r["folded"]).hex() != manifest.root]
    assert len(rows) == 300 and wrong == [77]
    # Two runs of siblings in the part's tree (15 and up to 6) and two at the top.
    assert {len(r["siblings"]) for r in rows if r["key"] < 288} == {15 + 6 + 2}


# --- pieces ---


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return piece_bpe.load_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def test_pieces_equal_the_library(vocabulary):
    rng = random.Random(1)
    library = sentencepiece.SentencePieceProcessor(model_proto=vocabulary.model)
    encoder, decoder = piece_bpe.Encoder(vocabulary), piece_bpe.Decoder(vocabulary)
    texts = ["", " ", "   a  b   ", "\n\n x\t y", "▁a ▁▁ b", "<s> </s> <unk>", "é中文🎉​", "a" * 5000, " " * 3000, "x=0;" * 400, "\x00\x01 a\r\n", "０１２"]
    texts += ["".join(rng.choice("ab eé ▁\n中🎉.,0thin") for _ in range(rng.randrange(200))) for _ in range(800)]
    import pyarrow as pa

    for more in ([], ["\U0010ffff a  b\n", None]):  # the sign that marks borders, too
        column = piece_bpe.Encoder(vocabulary).encode_column(pa.array(texts[3:] + more).slice(1))
        assert column.to_pylist() == [library.encode(t or "", add_eos=True) for t in texts[4:] + more]
    for text, found in zip(texts, encoder.encode(texts)):
        ids = np.frombuffer(found, np.int32)
        assert ids.tolist() == library.encode(text, add_eos=True)
        assert decoder.decode(ids).decode() == library.decode(ids.tolist()) == text.replace("▁", " ")


def test_any_ids_decode_as_the_library_does(vocabulary):
    rng = random.Random(2)
    library = sentencepiece.SentencePieceProcessor(model_proto=vocabulary.model)
    decoder = piece_bpe.Decoder(vocabulary)
    for most, size in ((32000, 6), (259, 6), (300, 40)):
        for _ in range(500):
            ids = [rng.randrange(most) for _ in range(rng.randrange(size))]
            assert decoder.decode(np.array(ids, np.int64)).decode() == library.decode(ids)


def test_pieces_of_odd_rows(spark, vocabulary):
    rows = [(i, t, 1.0) for i, t in enumerate(ODD)] + [(3, "one", 1.0), (None, "one", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded double")
    found = piece_bpe.encoded_and_checked(docs, vocabulary).collect()
    assert len(found) == len(rows) and all(r["agrees"] for r in found)
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in found)
    assert [list(r["ids"]) for r in found if not r["text"]] == [[2], [2]]
    both = piece_bpe.decode_pieces(piece_bpe.encode_pieces(docs, vocabulary), vocabulary).collect()
    assert sorted(map(str, both)) == sorted(str(r) for r in spark.createDataFrame(found).drop("agrees").select(*both[0].asDict()).collect())
    assert piece_bpe.encoded_and_checked(docs.limit(0), vocabulary).count() == 0


def test_other_models_are_refused(vocabulary):
    with pytest.raises(ValueError):
        piece_bpe.Vocabulary(vocabulary.model[: vocabulary.model.rindex(b"identity") - 4])
