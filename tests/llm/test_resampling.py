"""Importance resampling against plain counting, the radix sort against a sort."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from specflow.llm import resampling as rs
from tests.compare import check, connect

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(docs, target, least=20, share=(10, 100)):
    s, t = Counter(), Counter()
    for text in docs.values():
        s.update(crc32(w.encode()) % 10_000 for w in words(text[1]))
    for text in target:
        t.update(crc32(w.encode()) % 10_000 for w in words(text))
    total, wanted = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (total + 10_000) / ((s[b] + 1) * (wanted + 10_000))))

    rows = []
    for doc_id, text in docs.values():
        found = words(text)
        weight = sum(gain(crc32(w.encode()) % 10_000) for w in found)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    drawn = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {}
    for n, r in enumerate(drawn[: len(drawn) * share[0] // share[1]]):
        ranks.setdefault(r, []).append(n + 1)
    return Counter((*r, ranks[r].pop() if ranks.get(r) else None) for r in sorted(rows, key=repr))


def check_resample(docs, target, **settings):
    src = {i: (r.doc_id, r.text) for i, r in enumerate(docs.select("doc_id", "text").collect())}
    got = rs.resample(docs, target, **settings)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = plain(src, [r.text for r in target.collect()], settings.get("least_words", 20), settings.get("share", (10, 100)))
    assert Counter(tuple(r) for r in got.collect()) == want


def test_against_plain_counting(spark, odd_documents, no_documents):
    docs, target = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    check_resample(docs, target)
    check_resample(odd_documents, target, least_words=1, share=(100, 100))
    check_resample(odd_documents, target.where("false"), least_words=3, share=(1, 2))
    check_resample(odd_documents.withColumn("__place", F.lit(1)).withColumn("rank", F.lit("x")), target)
    assert rs.resample(no_documents, target).collect() == []


def test_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    docs, target = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    assert check(rs.resample(docs, target), connect(sf), rs.ORACLE) is None


def test_words_in_portions(monkeypatch):
    text = "Ab c1-É北京_x " * 40 + "ünï"
    want = [w.encode() for w in words(text)]
    assert sum(rs.words_in(text), []) == want
    monkeypatch.setattr(rs, "PORTION", 7)
    assert sum(rs.words_in(text), []) == want
    assert list(rs.words_in(None)) == [] and sum(rs.words_in("--"), []) == []


@pytest.mark.parametrize("digit_bits, block_rows", [(8, 16), (3, 1), (11, 64), (10, None)])
def test_radix_sort_is_a_stable_sort(spark, digit_bits, block_rows):
    rows = [(i, (i * 7919 % 37 - 18) * 10**k, i % 5) for k in (0, 6) for i in range(200)]
    table = spark.createDataFrame(rows, "id long, a long, b long").repartition(5, "id")
    got = rs.radix_ranks(table, [F.col("a"), F.col("b")], digit_bits=digit_bits, block_rows=block_rows)
    found = sorted(got.collect(), key=lambda r: r.rank)
    assert [r.rank for r in found] == list(range(1, 401))
    assert [(r.a, r.b) for r in found] == sorted((a, b) for _, a, b in rows)


def test_radix_sort_of_extreme_and_equal_keys(spark):
    values = [-(1 << 63), (1 << 63) - 1, 0, -1, 1, 1 << 40, -(1 << 40), 7, 7, 7]
    table = spark.createDataFrame([(v,) for v in values], "v long")
    found = sorted(rs.radix_ranks(table, [F.col("v")]).collect(), key=lambda r: r.rank)
    assert [r.v for r in found] == sorted(values)
    same = rs.radix_ranks(spark.createDataFrame([(5,)] * 300, "v long").repartition(7), [F.col("v")], block_rows=4)
    assert sorted(r.rank for r in same.collect()) == list(range(1, 301))
    assert rs.radix_ranks(table.where("false"), [F.col("v")]).collect() == []
