"""Token blocks and packing against the tokenizers library itself."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from specflow.llm import packing, pfor, tokens
from specflow.session import table_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    library = Tokenizer.from_file(tokens.DEFAULT_TOKENIZER)
    return lambda text: library.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.DEFAULT_TOKENIZER, keep=50)


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.sampled_from("ab'stZé1٣ \t\n\r \x1c\x85,.!-#<|>北"), max_size=40))
def test_encoder_equals_the_library(encoder, plain, text):
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == plain(text)


@settings(max_examples=60, deadline=None)
@given(ids=st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1200), share=st.floats(0, 1))
def test_shard_round_trip(ids, share):
    counts = [len(ids) // 2, 0, len(ids) - len(ids) // 2]
    shard = pfor.encode_shard([5, None, -7], counts, np.array(ids, np.uint32), share)
    back = pfor.decode_shard(shard)
    assert (back[0], back[1], back[2].tolist()) == ([5, None, -7], counts, ids)
    assert pfor.read_run(shard, 200, 300).tolist() == ids[200:500]


def test_outliers_go_to_the_exception_list():
    ids = np.full(256, 1000, np.uint32)
    ids[::32] = 4_000_000_000
    small = len(pfor.encode_shard([1], [256], np.full(256, 1000, np.uint32)))
    assert len(pfor.encode_shard([1], [256], ids)) == small + 8 * 5


def test_damaged_shards_are_refused():
    shard = pfor.encode_shard([1], [3], np.array([1, 2, 3], np.uint32))
    for bad in (b"XXXX" + shard[4:], shard[:-1], shard + b"\0"):
        with pytest.raises(ValueError):
            pfor.decode_shard(bad)


def check_blocks(spark, docs, plain, **settings):
    path = table_path(spark, "test-blocks")
    pfor.write_token_blocks(docs, path, **settings)
    got = sorted(pfor.read_token_blocks(spark, path).collect(), key=lambda r: r.start)
    want = defaultdict(Counter)
    for row in docs.select("doc_id", "text").collect():
        ids = np.array([*plain(row.text), 0], "<u4")
        want[row.doc_id][len(ids), zlib.crc32(ids.tobytes())] += 1
    have = defaultdict(Counter)
    start = 0
    for row in got:
        assert row.start == start
        start += row.n_tokens
        have[row.doc_id][row.n_tokens, row.ids_crc32] += 1
    assert have == want
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)


def test_blocks(spark, odd_documents, no_documents, plain):
    check_blocks(spark, odd_documents, plain, shard_ids=100)
    check_blocks(spark, no_documents, plain)
    check_blocks(spark, spark.read.parquet(f"{SF}/documents.parquet"), plain)


def check_packing(rows, docs, plain, capacity=1024):
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    want = Counter()
    for row in docs.select("doc_id", "text").collect():
        ids = np.array([*plain(row.text), 2], "<u4")
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[row.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    return len(sequences)


def test_packing(spark, odd_documents, no_documents, plain):
    check_packing(packing.pack(odd_documents).collect(), odd_documents, plain)
    check_packing(packing.pack(odd_documents, capacity=16).collect(), odd_documents, plain, 16)
    assert packing.pack(no_documents).collect() == []
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack(docs).collect()
    used = check_packing(rows, docs, plain)
    assert used <= -(-sum(r.length for r in rows) // 1024) * 1.02 + 1


def plan_holds(plan, counts, capacity):
    held = np.zeros(capacity + 1, np.int64)
    for lengths, times in plan:
        assert lengths.sum() <= capacity and times > 0
        np.add.at(held, lengths, times)
    assert held.tolist() == list(counts)
    return sum(times for _, times in plan)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_plan_holds_exactly_the_pieces(lengths):
    counts = np.bincount(lengths, minlength=21)
    used = plan_holds(packing.solve(counts, 20), counts, 20)
    best_fit = sum(t for _, t in packing._fill_best(counts, 20))
    assert -(-sum(lengths) // 20) <= used <= best_fit


def test_linear_program_beats_best_fit():
    chance = np.random.default_rng(1)
    counts = np.bincount(chance.integers(200, 500, 5000), minlength=1025)
    used = plan_holds(packing.solve(counts, 1024), counts, 1024)
    assert used < 0.98 * sum(t for _, t in packing._fill_best(counts, 1024))
