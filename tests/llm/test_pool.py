"""Quality labels that are few, and a pool that is learned from as a whole."""

import numpy as np
from pyspark.sql import functions as F

from specflow.llm import cotraining

SF = "/root/testdata/sf0.001"


def test_labelled_rows_do_not_shrink_as_the_unlabelled_grow(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    labelled = docs.join(labels.select("doc_id"), "doc_id", "left_semi").select(docs.columns)
    plain = docs.join(labels.select("doc_id"), "doc_id", "left_anti").select(docs.columns)
    more = plain.crossJoin(spark.range(1, 21)).withColumn("doc_id", F.col("doc_id") + 10_000 * F.col("id"))
    seen = {}

    def held(content, metadata, label, part, *, weight, pool, **settings):
        seen["labelled"] = len(label)
        models = [np.zeros(content.shape[1] + 1), np.zeros(metadata.shape[1] + 1)]
        seen["pool"] = int(pool(cotraining.pool_counts, [], models)[0].sum())

    monkeypatch.setattr(cotraining, "co_train", held)
    cotraining.train(labelled.unionByName(more.select(docs.columns)), labels, sample=100)
    assert seen == {"labelled": labelled.count(), "pool": 20 * plain.count()}


def test_sums_of_stored_features_equal_those_of_arrays(spark):
    chance = np.random.default_rng(2)
    views = [(chance.random((60, w)) * (chance.random((60, w)) < 0.1)).astype(np.float32) for w in (522, 257)]
    rows = [(bytearray(cotraining._packed(c)), bytearray(cotraining._packed(m))) for c, m in zip(*views)]
    pool = cotraining._pool_of(spark.createDataFrame(rows, "content binary, meta binary").repartition(7))
    models = [chance.normal(size=w + 1) for w in (522, 257)]
    history = [(models, [(2900, 3300), (2950, 3250)])]
    assert (pool(cotraining.pool_counts, history, models) == cotraining.pool_counts(views, history, models)).all()
    want = cotraining.pool_sums(views, history, models)
    assert want[0] > 0 and np.allclose(pool(cotraining.pool_sums, history, models), want, rtol=1e-4, atol=1e-4)


def plain_loop(views, y, train, pool, rounds, share):
    """Co-training as it is usually written: labels kept in arrays, models refitted to the end on all rows they have."""
    labels = [np.full(len(pool[0]), -1), np.full(len(pool[0]), -1)]
    prior = y[train].mean()
    models = [cotraining.logistic(v[train], y[train].astype(float)) for v in views]
    left = np.ones(len(pool[0]), bool)
    for _ in range(rounds):
        counts = np.stack([np.bincount(cotraining.bins_of(v[left], m), minlength=cotraining.BINS) for v, m in zip(pool, models)])
        cuts = cotraining._cuts(counts, prior, share)
        gone = np.zeros(len(left), bool)
        for k, (low, high) in enumerate(cuts):
            at = cotraining.bins_of(pool[k], models[k])
            for label, hit in ((0, left & (at <= low)), (1, left & (at >= high))):
                labels[1 - k][hit] = label
                gone |= hit
        left &= ~gone
        models = [
            cotraining.logistic(np.vstack([v[train], u[g >= 0]]), np.concatenate([y[train], g[g >= 0]]).astype(float), steps=60)
            for v, u, g in zip(views, pool, labels)
        ]
    return models


def test_against_a_plain_loop(monkeypatch):
    chance = np.random.default_rng(11)
    n, widths = 3000, (12, 6)
    truth = chance.random(n) < 0.5
    views = [chance.normal(size=(n, w)).astype(np.float32) + np.where(truth, 0.4, -0.4)[:, None].astype(np.float32) for w in widths]
    label = np.where(np.arange(n) < 300, truth, -1).astype(int)
    part = np.arange(n) % 3
    train = np.flatnonzero((label >= 0) & (part > 0))
    pool = [v[label < 0] for v in views]
    want = plain_loop(views, label, train, pool, 3, 0.1)
    monkeypatch.setattr(cotraining, "STEPS", 30)
    monkeypatch.setattr(cotraining, "LAST_STEPS", 30)

    def summed(what, history, models):  # the pool elsewhere, in parts
        return sum(what([v[k::3] for v in pool], history, models).astype(float) for k in range(3))

    for extra in ({}, {"pool": summed}):
        got = cotraining.co_train(*views, label, part, rounds=3, share=0.1, **extra)
        z = [cotraining.odds(v, m) for v, m in zip(views, got["models"])]
        for a, m, v in zip(z, want, views):
            assert np.abs(a - cotraining.odds(v, m)).max() < 0.05
        both = cotraining.score_views(*views, got)[2]
        assert ((both >= 0.5) == truth)[label < 0].mean() > 0.9


def test_held_out_accuracy(spark):
    """Half of the labels, by a hash, are kept from training: about 200 rows are left to learn from."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    apart = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    model = cotraining.train(docs, labels.where(apart))
    rows = cotraining.score_documents(docs, model).join(labels.where(~apart), "doc_id").collect()
    assert len(rows) > 150 and sum(r.good == (r.quality == 1) for r in rows) >= 0.85 * len(rows)
