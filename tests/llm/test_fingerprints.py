"""Bottom-k sketches against whole shingle sets."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from specflow.llm import fingerprints as fp

SF = "/root/testdata/sf0.001"


def shingles(text, width=fp.WIDTH):
    words = (text or "").encode().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check_next(docs, error):
    src = sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").where("doc_id IS NOT NULL").collect()), reverse=True)
    got = fp.compare_with_next(docs)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    rows = got.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(d for d, _ in src)
    texts: dict = {}
    for d, t in src:
        texts.setdefault(d, set()).add(t)
    copies = Counter(d for d, _ in src)
    ids = sorted(texts, reverse=True)
    for r in rows:
        if r.doc_id is None:
            continue
        after = ids[(ids.index(r.doc_id) + 1) % len(ids)]
        fits = [(t, n) for t in texts[r.doc_id] for n in texts[after] | texts[r.doc_id] if hashlib.sha256(fp.edited(t, n).encode()).hexdigest() == r.edited_sha256 and len(t) == r.n_chars]
        assert fits
        if copies[r.doc_id] == len(texts[after]) == 1:
            (text,), (following,) = texts[r.doc_id], texts[after]
            assert r.fingerprint == fp.to_text(fp.sketch(text)) and r.edited_fingerprint == fp.to_text(fp.sketch(fp.edited(text, following)))
            assert abs(r.near_edited - jaccard(shingles(text), shingles(fp.edited(text, following)))) <= error
            assert abs(r.near_next - jaccard(shingles(text), shingles(following))) <= error
    return rows


def test_each_document_with_its_next(spark, odd_documents, no_documents):
    assert len(check_next(spark.read.parquet(f"{SF}/documents.parquet"), 0.12)) == 200
    rows = check_next(odd_documents, 0.12)
    assert len(rows) == odd_documents.count()
    lone = [r for r in rows if r.doc_id is None]
    assert all(r.near_next == 1.0 for r in lone)
    assert check_next(no_documents, 0) == []
    one = odd_documents.where("doc_id = 1")
    assert [r.near_next for r in check_next(one, 0)] == [1.0]


def test_many_parts_keep_the_order(spark):
    docs = spark.range(0, 3000, 7).selectExpr("id * id AS doc_id", "concat('text number ', id, ' with a few words ', id % 5) AS text")
    docs = docs.repartition(40)
    check_next(docs, 0)  # fewer shingles than k: exact


def test_edit():
    assert fp.edited("abcdef", "XY") == "abcXY"
    assert fp.edited("abcde", "WXYZ") == "abcWX"
    assert fp.edited("", "xyz") == "" and fp.edited("a", "b") == "a"
    assert fp.edited("\U0001f600é北x", "ab") == "\U0001f600éab"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=300), st.lists(st.integers(0, 400), max_size=300), st.integers(4, 64))
def test_merged_sketches_are_sketches_of_the_union(a, b, k):
    def hashed(xs):
        return np.array([int(hashlib.md5(str(x).encode()).hexdigest()[:12], 16) for x in xs], np.uint64)

    whole = fp.smallest(hashed(a + b), k)
    assert (fp.smallest(np.concatenate([fp.smallest(hashed(a), k), fp.smallest(hashed(b), k)]), k) == whole).all()
    assert (fp.from_text(fp.to_text(whole, k))[0] == whole).all() and fp.from_text(fp.to_text(whole, k))[1] == k
    x, y = fp.smallest(hashed(a), 1000), fp.smallest(hashed(b), 1000)
    assert fp.resemblance(x, y, 1000) == pytest.approx(jaccard(set(a), set(b)))
    assert fp.containment(x, y, 1000) == pytest.approx(len(set(a) & set(b)) / len(set(a)) if a else 1.0)
    assert fp.distinct_count(x, 1000) == len(set(a))


def test_estimates_of_large_sets():
    a = " ".join(f"w{i}" for i in range(20_000))
    b = " ".join(f"w{i}" for i in range(10_000, 30_000))
    x, y = fp.sketch(a, 1024), fp.sketch(b, 1024)
    assert abs(fp.resemblance(x, y, 1024) - 1 / 3) < 0.06
    assert abs(fp.containment(x, y, 1024) - 1 / 2) < 0.08
    assert abs(fp.distinct_count(x, 1024) / 19_996 - 1) < 0.12
    part = fp.sketch(" ".join(f"w{i}" for i in range(300)), 1024)
    assert fp.containment(part, x, 1024) == 1.0


def test_long_texts_in_portions(monkeypatch):
    text = " ".join(f"w{i * i % 977}" for i in range(3000))
    short = {n: fp.sketch(" ".join(text.split()[:n])).tolist() for n in (1, 4, 5, 6, 99, 100, 101, 103, 104, 105, 3000)}
    monkeypatch.setattr(fp, "PORTION", 100)
    for n, want in short.items():
        raw = " ".join(text.split()[:n]) + " " * 900
        assert fp.sketch(raw).tolist() == want


def test_parts_merge_to_the_whole(spark, odd_documents):
    rows = [(i % 3 if i % 7 else None, f"word{i} and word{i * 5 % 31} go to word{i % 11} and on") for i in range(600)]
    docs = spark.createDataFrame(rows, "lang int, text string").withColumn("doc_id", F.monotonically_increasing_id()).repartition(9)
    prints = fp.fingerprint_documents(docs, k=32).join(docs.select("doc_id", "lang"), "doc_id")
    got = {r.lang: r.fingerprint for r in fp.merge_parts(prints, "lang").collect()}
    for key in (0, 1, 2, None):
        whole = fp.smallest(np.concatenate([fp.sketch(t, 32) for k, t in rows if k == key]), 32)
        assert got[key] == fp.to_text(whole, 32)
    assert len(got) == 4
    assert fp.merge_parts(prints.where("false"), "lang").collect() == []


def test_columns(spark):
    texts = ["a b c d e f g h", "a b c d e f g h", "b c d e f g h i", "", None]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    prints = fp.fingerprint_documents(table)
    rows = prints.crossJoin(prints.withColumnsRenamed({"doc_id": "other", "fingerprint": "its"})).select(
        "doc_id", "other", fp.resemblance_of("fingerprint", "its").alias("r"), fp.containment_of("fingerprint", "its").alias("c"),
        fp.distinct_count_of("fingerprint").alias("n"),
    )
    at = {(r.doc_id, r.other): (r.r, r.c, r.n) for r in rows.collect()}
    assert at[0, 1] == (1.0, 1.0, 4.0) and at[0, 2] == (0.6, 0.75, 4.0) and at[3, 0] == (0.0, 1.0, 0.0) and at[3, 4] == (1.0, 1.0, 0.0)
    assert spark.range(1).select(fp.resemblance_of(F.lit(None).cast("string"), F.lit("AAE=")).alias("r")).first().r is None
