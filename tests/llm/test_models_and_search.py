"""Language, quality, token counts, decontamination and archives against plain versions."""

import base64
import hashlib
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from specflow.llm import cotraining, decontaminate, langid, unigram, warc
from specflow.session import table_path

SF = "/root/testdata/sf0.01"


def plain_marginals(scores, transition, start):
    emit, move = np.exp(scores), np.exp(transition)
    n, k = scores.shape
    forward, backward = np.zeros((n, k)), np.ones((n, k))
    forward[0] = np.exp(start) * emit[0]
    for t in range(1, n):
        forward[t] = (forward[t - 1] / forward[t - 1].sum()) @ move * emit[t]
    for t in range(n - 2, -1, -1):
        after = backward[t + 1] / backward[t + 1].sum()
        backward[t] = move @ (after * emit[t + 1])
    p = forward * backward
    return p / p.sum(axis=1, keepdims=True)


@settings(max_examples=30, deadline=None)
@given(lengths=st.lists(st.integers(1, 200), min_size=1, max_size=5), seed=st.integers(0, 1000))
def test_forward_backward_in_blocks(lengths, seed):
    chance = np.random.default_rng(seed)
    scores = 3 * chance.normal(size=(sum(lengths), 3))
    transition, start = chance.normal(size=(3, 3)), chance.normal(size=3)
    got = langid.marginals(scores, np.array(lengths), transition, start)
    ends = np.cumsum(lengths)
    want = np.concatenate([plain_marginals(scores[e - n : e], transition, start) for n, e in zip(lengths, ends)])
    assert np.abs(got - want).max() < 1e-9


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and 250 < len(held) < 420
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)


def test_language_learns_moves_and_labels_switches(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang IN ('en', 'de')")
    model = langid.train(docs)
    a = docs.where("lang = 'en' AND n_chars > 600").first().text
    b = docs.where("lang = 'de' AND n_chars > 600").first().text
    words = langid.words_of(a)[:60] + langid.words_of(b)[:60]
    p = langid.marginals(langid.word_scores(words, model), np.array([120]), model["transition"], model["start"])
    english = model["labels"].index("en")
    assert p[:60, english].mean() > 0.9 and p[60:, english].mean() < 0.1
    assert (np.diag(model["transition"]) > model["transition"].mean()).all()


def test_documents_in_no_learned_language_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    chance = np.random.default_rng(3)
    letters = " ".join("".join(chr(97 + int(c)) for c in chance.integers(0, 26, int(n))) for n in chance.integers(2, 10, 80))
    foreign = [
        "A nyelvek sokfélesége az emberi kultúra egyik legfontosabb öröksége, amelyet minden nemzedéknek meg kell őriznie",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw, są oni obdarzeni rozumem",
        "すべての人間は、生れながらにして自由であり、かつ、尊厳と権利とについて平等である",
        "Все люди рождаются свободными и равными в своем достоинстве и правах",
        letters,
        "12 34 -- !!",
    ]
    extra = spark.createDataFrame([(-k - 1, t, None, "x", len(t)) for k, t in enumerate(foreign)], docs.schema)
    kept = {r.doc_id for r in langid.keep_known(docs.unionByName(extra)).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()}


def test_training_rows_reach_the_driver_shortened(spark):
    rows = [(k % 3, f"alpha beta gamma delta number {'x' * (k % 5)} " * 400, "aa") for k in range(12)]
    rows += [(k, "uno dos tres cuatro cinco " * 300, "bb") for k in range(20, 32)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, row_words=50)
    assert model["labels"] == ["aa", "bb"]
    assert langid.label_texts(pa.array(["dos tres", "gamma delta"]), model)[0] == ["bb", "aa"]


def test_every_quotation_of_a_hundred_characters_is_found(spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    chance = np.random.default_rng(5)
    rows, want = [], set()
    for r in items:
        text = decontaminate.normal(r.text)
        for length in (100, 120, 150):
            if len(text) > length:
                at = int(chance.integers(0, len(text) - length))
                rows.append((len(rows), "zq xj " * 9 + text[at : at + length] + " vk wy" * 9))
                want.add((rows[-1][0], r.item_id))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.find_passages(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
    assert len(want) > 20 and want <= {(r.doc_id, r.item_id) for r in found}


def test_language_odd_rows(spark, odd_documents, no_documents):
    rows = langid.identify(odd_documents).collect()
    got = Counter((r.doc_id, r.lang_pred) for r in rows)
    assert len(rows) == odd_documents.count() and all(0 <= r.score <= 1 for r in rows)
    for unknown in (3, 4, 5, 8):
        assert got[unknown, "und"] == 1
    assert langid.identify(no_documents).collect() == []
    unlabelled = langid.identify(odd_documents.withColumn("lang", odd_documents.lang.substr(99, 1)).selectExpr("doc_id", "text", "nullif(lang, '') AS lang"))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}
    kept = langid.keep_known(odd_documents)
    assert kept.columns == odd_documents.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 6, 7, None, 9, 10}


def test_quality(spark, odd_documents, no_documents):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = cotraining.train(docs, labels)
    rows = cotraining.score_documents(docs, model).join(labels, "doc_id").collect()
    assert sum(r.good == (r.quality == 1) for r in rows) >= 0.95 * len(rows)
    odd = cotraining.score_documents(odd_documents, model).collect()
    assert len(odd) == odd_documents.count() and all(0 <= r.score <= 1 for r in odd)
    assert {r.score for r in cotraining.score_documents(odd_documents, None).collect()} == {0.5}
    assert cotraining.train(no_documents, labels) is None
    assert cotraining.train(docs, labels.where("false")) is None
    assert cotraining.score_documents(no_documents, model).collect() == []


def test_views_teach_each_other():
    # labelled rows show only the content view's signal; the pool shows both together
    chance = np.random.default_rng(4)
    y = chance.integers(0, 2, 3000)
    content = np.stack([y + 0.2 * chance.normal(size=3000), chance.normal(size=3000)], axis=1)
    metadata = np.stack([y + 0.2 * chance.normal(size=3000), chance.normal(size=3000)], axis=1)
    label = np.where(np.arange(3000) < 90, y, -1)
    metadata[:90, 0] = chance.normal(size=90)
    part = np.arange(3000) % 3
    alone = cotraining.co_train(content, metadata, label, part, rounds=0)
    taught = cotraining.co_train(content, metadata, label, part, rounds=4)
    second = [((cotraining.odds(metadata[90:], m["models"][1]) > 0) == y[90:]).mean() for m in (alone, taught)]
    assert second[1] > 0.95 > second[0]


def plain_segments(word, pieces):
    word = unigram.MARK + word
    longest = max(map(len, pieces))
    best = [(0.0, 0)]
    for i in range(1, len(word) + 1):
        options = [(-best[j][0] - pieces[word[j:i]], best[j][1] + 1) for j in range(max(0, i - longest), i) if word[j:i] in pieces]
        if word[i - 1] not in pieces:
            size = len(word[i - 1].encode())
            options.append((-best[i - 1][0] - size * pieces[""], best[i - 1][1] + size))
        low = min(options)
        best.append((-low[0], low[1]))
    return best[-1]


def test_token_counts(spark, odd_documents, no_documents):
    pieces = unigram.load_scores(unigram.DEFAULT_VOCABULARY)
    docs = odd_documents.select("doc_id", "text").union(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id % 40 = 0"))
    cache = {}
    want = Counter()
    for row in docs.collect():
        words = (row.text or "").split()
        for w in words:
            if w not in cache:
                cache[w] = plain_segments(w, pieces)
        want[row.doc_id, len(words), sum(cache[w][1] for w in words), round(math.fsum(cache[w][0] for w in words), 4)] += 1
    got = Counter((r.doc_id, r.n_pretokens, r.n_tokens, round(r.score, 4)) for r in unigram.count_tokens(docs).collect())
    assert got == want
    assert unigram.count_tokens(no_documents).collect() == []


def test_trie_forgets_without_changing_counts():
    pieces = unigram.load_scores(unigram.DEFAULT_VOCABULARY)
    texts = ["the then they there", "other others", "the then"]
    small, large = unigram.Trie(pieces, most_nodes=3), unigram.Trie(pieces)
    assert list(map(small.count_text, texts)) == list(map(large.count_text, texts))


def test_endless_words_equal_the_plain_segmentation():
    pieces = unigram.load_scores(unigram.DEFAULT_VOCABULARY)
    start = "".join(f"thequick{i * i}bröwn漢字" for i in range(60))
    words = [start[:255], start[:256], start[:257], start[:511], start[:512], start[:513], start + "s", start + "ed", start]
    trie = unigram.Trie(pieces)
    for word in words:
        n, tokens, score = trie.count_text(word)
        weight, fewest = plain_segments(word, pieces)
        assert (n, tokens) == (1, fewest) and math.isclose(score, weight)
    shared = len(trie.runs)
    assert trie.count_text(start + " " + start)[:2] == (2, 2 * plain_segments(start, pieces)[1])
    assert len(trie.runs) == shared  # nothing is scored twice


def test_trie_of_a_long_text_stays_small(monkeypatch):
    pieces = unigram.load_scores(unigram.DEFAULT_VOCABULARY)
    whole = unigram.Trie(pieces)
    trie = unigram.Trie(pieces)
    trie.count_text("ab" * 100_000)
    assert len(trie.score) < 2 + unigram.DENSE + 200_000 / unigram.RUN
    text = " ".join(f"w{i}\u2003x{i * 7919}" for i in range(3000))
    want = whole.count_text(text)
    monkeypatch.setattr(unigram.portions, "__defaults__", (1000,))
    trie = unigram.Trie(pieces, most_nodes=500)
    assert trie.count_text(text) == want and len(trie.score) < 2500
    assert [w for p in unigram.portions(text) for w in p.split()] == text.split()


def nearest(passage, text):
    """Fewest edits between the passage and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(passage, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j - 1] + (a != b), last[j] + 1, row[j - 1] + 1))
    return min(row)


@settings(max_examples=60, deadline=None)
@given(data=st.data())
def test_passage_search_finds_every_place_within_budget(data):
    alphabet = st.text(alphabet="abcde fgh", min_size=30, max_size=60)
    passage = decontaminate.normal(data.draw(alphabet))
    text = list(passage)
    for _ in range(data.draw(st.integers(0, 4))):
        at = data.draw(st.integers(0, max(0, len(text) - 1)))
        kind = data.draw(st.integers(0, 2))
        if kind == 0 and text:
            del text[at]
        elif kind == 1:
            text.insert(at, "x")
        elif text:
            text[at] = "y"
    text = data.draw(alphabet) + "".join(text) + data.draw(alphabet)
    q = 5
    if len(passage) < q:
        return
    index = decontaminate.build_index([(1, passage)], q, 0.1)
    budget = min(int(0.1 * len(passage)), len(passage) // q - 1)
    found = decontaminate.search(index, [text, "none of it"])
    least = nearest(passage, text)
    assert bool([f for f in found if f[0] == 0]) == (least <= budget)
    if least <= budget:
        assert min(f[4] for f in found) == least


def test_passage_search_in_stretches(monkeypatch):
    rng = np.random.default_rng(5)
    letters = np.array(list("abcd "))
    phrase = "".join(rng.choice(letters, 60))
    passages = [(k, decontaminate.normal(phrase + "".join(rng.choice(letters, 60)))) for k in range(40)]
    texts = []
    for k in range(10):
        p = list(passages[k][1])
        for _ in range(k % 5):
            p[int(rng.integers(len(p)))] = "x"
        texts.append("".join(rng.choice(letters, 200)) + (phrase * 3) + "".join(p) + "".join(rng.choice(letters, 90)))
    index = decontaminate.build_index(passages, 12, 0.05)
    whole = sorted(decontaminate.search(index, texts))
    assert {(t, t) for t in range(10)} <= {(t, k) for t, k, *_ in whole}
    for at_once in (1, 3_000):
        monkeypatch.setattr(decontaminate, "AT_ONCE", at_once)
        assert sorted(decontaminate.search(index, texts)) == whole


def test_words_cover_the_whole_text():
    assert "".join(langid.words_of("a" * 70 + "bc")) == "a" * 70 + "bc"
    assert langid.words_of("\u00bd \u00b2 12 _ !") == []
    assert langid.words_of("5 m\u00b2") == ["m\u00b2"]


def test_decontamination(spark, odd_documents, no_documents):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    plain_docs = [(r.doc_id, decontaminate.normal(r.text)) for r in docs.collect()]
    want = {(d, r.item_id) for r in items.collect() for d, t in plain_docs if decontaminate.normal(r.text) in t}
    found = decontaminate.find_passages(docs, items).collect()
    assert want and {(r.doc_id, r.item_id) for r in found} == want and {r.edits for r in found} == {0}
    in_blocks = decontaminate.find_passages(docs, items, block=30)
    assert Counter(map(tuple, in_blocks.collect())) == Counter(map(tuple, found))
    clean = decontaminate.drop_contaminated(docs, items)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in plain_docs} - {d for d, _ in want}
    own = spark.createDataFrame([(1, "Then a THIRD ends  it"), (2, None), (None, "ends it"), (4, ""), (5, "not there at all")], "item_id long, text string")
    rows = {(r.doc_id, r.item_id) for r in decontaminate.find_passages(odd_documents, own).collect()}
    assert rows == {(d, i) for d in (1, 2, 7) for i in (1, None)}
    assert decontaminate.find_passages(no_documents, own).collect() == []
    assert decontaminate.find_passages(odd_documents, own.where("false")).collect() == []
    assert decontaminate.drop_contaminated(odd_documents, own.where("false")).count() == odd_documents.count()


def test_archives(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    twice = pages.selectExpr("page_id + 1000 AS page_id", "url", "IF(page_id % 5 = 0, NULL, html) AS html")
    odd = spark.createDataFrame([(None, None, "x"), (5000, "u\r\nX: y", "x"), (5001, "", ""), (None, "u", "only here"), (5002, "u", "é\r\n\r\n北")], twice.schema)
    table = pages.unionByName(twice).unionByName(odd)
    path = table_path(spark, "test-archives")
    warc.write_archives(table, path, archive_bytes=200_000)
    rows = [(r.page_id, (r.html or "").encode()) for r in table.collect()]
    latest = {}
    for page, body in rows:
        if page is not None:
            latest[body] = max(latest.get(body, -1), page)
    want = Counter()
    for page, body in rows:
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        last = latest.get(body, page)
        want[page, len(body), digest, "response" if last == page else "revisit", None if last == page else last] += 1
    assert Counter(map(tuple, warc.read_archives(spark, path).collect())) == want
    empty = table_path(spark, "test-archives")
    warc.write_archives(table.where("false"), empty)
    assert warc.read_archives(spark, empty).collect() == []


def test_small_payloads_are_not_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    path = table_path(spark, "test-archives")
    warc.write_archives(pages, path, least_bytes=3)
    assert {(r.page_id, r.refers_to) for r in warc.read_archives(spark, path).collect()} == {(1, None), (2, None), (3, 4), (4, None)}


def test_damaged_archives_are_refused():
    body = b"hello"
    record = warc.make_record(1, "u", body, warc.sha1_base32(body), None)
    archive = warc.make_archive([record, record])
    assert list(warc.read_archive(archive)) == [record, record]
    for bad in (b"", archive[:6], b"\0\0\0\0" + archive[4:], archive[:-3]):
        with pytest.raises(Exception):
            list(warc.read_archive(bad))
    for bad in (record[:-1], record.replace(b"WARC/1.1", b"WARC/9.9"), record.replace(b"WARC-Date: ", b"Other: "), record.replace(b"hello", b"hallo")):
        with pytest.raises(ValueError):
            warc.page_of(bad)
