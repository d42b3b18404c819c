"""Hard negatives against all scores."""

import math
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from specflow.llm import negatives as ng
from tests.compare import check, connect

SF = "/root/testdata/sf0.001"
KIND = "vec_id long, embedding array<double>, label int"


def plain(rows, every=50, positives=5, negatives=3):
    usable = []
    for vec_id, v, label in rows:
        if vec_id is None or label is None or not v or any(x is None or not math.isfinite(x) or not math.isfinite(x * 256) for x in v):
            continue
        usable.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = Counter()
    for anchor, label, x in usable:
        if anchor % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), v, own) for v, own, y in usable if v != anchor and len(y) == len(x))
        for s, positive, _ in [r for r in scored if r[2] == label][:positives]:
            fits = [r for r in scored if r[2] != label and 50 * -s <= 100 * -r[0] <= 95 * -s][:negatives]
            for rank, (t, negative, _) in enumerate(fits, 1):
                out[(anchor, positive, rank, negative, -s, -t)] += 1
    return out


def check_mine(spark, rows, every=50, **settings):
    table = spark.createDataFrame(rows, KIND)
    got = ng.mine(table, anchors=every, **settings)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    found = Counter(tuple(r) for r in got.collect())
    assert found == plain(rows, every)
    return found


def test_against_sql(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        table = spark.read.parquet(f"{sf}/embeddings.parquet")
        assert check(ng.mine(table), connect(sf), ng.ORACLE) is None


def test_blocks_of_anchors(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert check(ng.mine(table, block_bytes=2500), connect(SF), ng.ORACLE) is None


def test_odd_rows(spark):
    chance = np.random.default_rng(5)
    rows = [(i, (chance.normal(size=6) * 2).round(2).tolist(), int(i % 3)) for i in range(120)]
    rows += [(i, [1.0, 0.0, 0.5, 0.0, 0.0, 0.0], i % 3) for i in range(200, 280)]  # copies: ties go by vec_id
    rows += [(300, [0.0] * 6, 1), (301, None, 1), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (303, [math.nan] * 6, 1), (304, [math.inf] * 6, 1)]
    rows += [(305, [1.0] * 6, None), (None, [1.0] * 6, 1), (306, [1e307] * 6, 1), (307, [], 1)]
    rows += [(310, [1.0, 2.0], 1), (311, [2.0, 1.0], 1), (320, [1.0, 1.5], 2), (322, [-0.001, -1.0], 2)]  # another length
    rows += [rows[10], rows[10]]  # repeated anchors and candidates
    assert check_mine(spark, rows, 10)
    assert check_mine(spark, rows, 8, block_bytes=2000)
    assert check_mine(spark, [], 10) == Counter()
    assert check_mine(spark, rows[:1], 10) == Counter()
    assert check_mine(spark, [(10, [1.0], 1), (11, [2.0], 1)], 10) == Counter()


def test_scores_beyond_doubles(spark):
    chance = np.random.default_rng(6)
    rows = [(i, (chance.integers(-(1 << 30), 1 << 30, 4) / 256.0).tolist(), int(i % 2)) for i in range(60)]
    rows[3] = (3, [float(1 << 30), 1.0, 0.0, 0.0], 1)
    assert check_mine(spark, rows, 10)


def test_extra_columns(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").selectExpr("*", "1 AS search", "2 AS norm", "'x' AS rank", "0 AS near")
    assert check(ng.mine(table), connect(SF), ng.ORACLE) is None


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 40), st.sampled_from([1e-2, 1.0, 1e4]))
def test_bounds_hold_every_score(seed, n, scale):
    chance = np.random.default_rng(seed)
    base = np.floor(chance.normal(size=(n, 5)) * 256 * scale)
    base[chance.random(n) < 0.2] = 0
    base[1:] = np.where(chance.random((n - 1, 1)) < 0.3, base[:1] * 2, base[1:])  # parallel rows: angles of 0
    references = ng.pick_references([r for r in base] or [np.ones(5)], 3)[5]
    rows = ng.Rows(np.arange(n), np.zeros(n), ng._norms(base), base, ng._angles(base, references))
    starts = np.arange(0, n, 4)
    low, high = ng.window_bounds(rows, rows, starts)
    exact = base @ base.T
    for w, begin in enumerate(starts):
        part = exact[:, begin : begin + 4]
        assert (part.min(axis=1) >= low[:, w]).all() and (part.max(axis=1) <= high[:, w]).all()
