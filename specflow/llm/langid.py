"""Language of documents by a linear-chain conditional random field over their words.

Words are runs of letters; a run of more than 40 is several words.  The features
of a word are its prefixes and suffixes of up to three letters, its letter bigrams
and trigrams with word ends, and the share of each language among the training
occurrences of the word if it is in the lexicon.  Weights of (feature, language) and transitions between neighbouring
words' languages are learned together by stochastic gradient on the likelihood of
whole word sequences, so a text that switches language is labelled word by word
by forward-backward.  A document's language is the one with the largest mean
word probability, which is its score.

Training sees at most about ``per_language`` documents of each language, chosen by
a hash of doc_id and text over all labelled rows, and of each its first ``ROW_WORDS``
words.  Each training sequence joins runs of
words of different documents, so that switches occur.  Text and lang of the
training rows are the only things learned from.

Prediction runs over whole texts.  The words of a batch are cut into blocks of
``BLOCK``; products of the chain's matrices over each block join the blocks
exactly, so a very long text needs no long loop.

Null text or a text without letters: ``und`` with score 0.  No training rows: all
``und``.  Equal probabilities: the language that sorts first.  Repeated rows are
predicted alike.  Null doc_id: predicted, never trained on.  Empty table: empty
result.  Other columns are ignored.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specflow.llm.worker import bounded_slices, kept

WORD = re.compile(r"[^\W\d_]{1,40}")
UNKNOWN = "und"
BITS = 16
BLOCK = 64
SEEN = 0.9  # share of its trigrams that makes a word known
ROW_WORDS = 2_000  # words of a training row that reach the driver
PREDICTED = "doc_id long, lang_pred string, score double"


def words_of(text: str | None) -> list[str]:
    found = WORD.findall(text.lower()) if text else []
    return [w for w in found if w.isalpha() or any(map(str.isalpha, w))]  # not fractions and raised digits alone


def features_of(word: str) -> list[int]:
    """Hashed affix and n-gram features."""
    ends = f"^{word}$"
    n = len(ends)
    names = [f"p{ends[1 : k + 1]}" for k in range(1, min(4, n - 1))]
    names += [f"s{ends[-k - 1 : -1]}" for k in range(1, min(4, n - 1))]
    names += [ends[i : i + 2] for i in range(n - 1)] + [ends[i : i + 3] for i in range(n - 2)]
    return [crc32(x.encode()) & ((1 << BITS) - 1) for x in names]


def grams_of(word: str) -> list[str]:
    """Letter trigrams with word ends."""
    ends = f"^{word}$"
    return [ends[i : i + 3] for i in range(len(ends) - 2)]


def is_known(word: str, model: dict) -> bool:
    """Whether training saw the word often, or nearly all of its trigrams."""
    if word in model["lexicon"]:
        return True
    grams = grams_of(word)
    return sum(g in model["grams"] for g in grams) >= SEEN * len(grams)


def word_scores(words: list[str], model: dict, found: list[list[int]] | None = None) -> np.ndarray:
    """(words, languages) scores; a word's features share their weight, so long words count no more than short ones."""
    found = found or [features_of(w) for w in words]
    sizes = np.array([len(f) for f in found])
    flat = np.fromiter((x for f in found for x in f), np.int64, int(sizes.sum()))
    starts = np.cumsum(sizes) - sizes
    scores = np.add.reduceat(model["weights"][flat], starts, axis=0) / np.sqrt(sizes)[:, None]
    rows = [k for k, w in enumerate(words) if w in model["lexicon"]]
    if rows:
        scores[rows] += np.array([model["lexicon"][words[k]] for k in rows]) * model["lexicon_weights"]
    return scores


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def marginals(scores: np.ndarray, lengths: np.ndarray, transition: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Forward-backward over sequences laid end to end: (words, languages) probabilities."""
    return forward_backward(scores, lengths, transition, start)[0]


def forward_backward(scores, lengths, transition, start) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities, forward messages, word factors and move factors."""
    n, k = scores.shape
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    move = np.exp(transition - transition.max())
    first = np.cumsum(lengths) - lengths
    blocks = -(-lengths // BLOCK)
    owner = np.repeat(np.arange(len(lengths)), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = first[owner] + nth * BLOCK
    size = np.minimum(BLOCK, first[owner] + lengths[owner] - begin)
    order = np.argsort(-size, kind="stable")
    begin_, size_ = begin[order], size[order]
    steps = int(size_[0]) if len(size_) else 0
    active = [int(np.searchsorted(-size_, -t, side="left")) for t in range(steps)]  # blocks longer than t

    long_ = np.flatnonzero(blocks > 1)
    product = np.broadcast_to(np.eye(k), (len(owner), k, k)).copy()  # only blocks of cut sequences need theirs
    if len(long_):
        cut = np.flatnonzero(np.isin(owner[order], long_))
        for t in range(steps):
            live = cut[cut < active[t]]
            if not len(live):
                break
            p = (product[live] @ move) * emit[begin_[live] + t][:, None, :]
            product[live] = p / p.max(axis=(1, 2), keepdims=True)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))

    enter = np.ones((len(owner), k)) / k  # state before a block's first word, in sorted order
    leave = np.ones((len(owner), k))  # weight of what follows a block
    start_ = np.exp(start - start.max())
    firsts = back[np.cumsum(blocks) - blocks] if len(blocks) else np.empty(0, np.int64)
    is_first = np.zeros(len(owner), bool)
    is_first[firsts] = True
    most = int(blocks.max()) if len(blocks) else 0
    base = np.cumsum(blocks) - blocks
    for step in range(1, most):
        s = np.flatnonzero(blocks > step)
        here, before = back[base[s] + step], back[base[s] + step - 1]
        if step == 1:  # the first block starts from ``start`` instead of a move
            v = start_ * emit[begin_[before]]
            v = v[:, None, :]
            rest = np.broadcast_to(np.eye(k), (len(s), k, k)).copy()
            for t in range(1, BLOCK):
                rest = (rest @ move) * emit[begin_[before] + t][:, None, :]
                rest /= rest.max(axis=(1, 2), keepdims=True)
            enter[here] = _normal((v @ rest)[:, 0])
        else:
            enter[here] = _normal((enter[before][:, None, :] @ product[before])[:, 0])
    for step in range(most - 2, -1, -1):
        s = np.flatnonzero(blocks > step + 1)
        here, after = back[base[s] + step], back[base[s] + step + 1]
        leave[here] = _normal((product[after] @ leave[after][:, :, None])[:, :, 0])

    forward = np.empty((n, k))
    state = enter.copy()
    for t in range(steps):
        m = active[t]
        if t == 0:
            came = np.where(is_first[:, None], start_, state @ move)
        else:
            came = state[:m] @ move
        state[:m] = _normal(came[:m] * emit[begin_[:m] + t])
        forward[begin_[:m] + t] = state[:m]
    out = np.empty((n, k))
    after = leave.copy()
    for t in range(steps - 1, -1, -1):
        m = active[t]
        at = begin_[:m] + t
        out[at] = _normal(forward[at] * after[:m])
        after[:m] = _normal((after[:m] * emit[at]) @ move.T)
    return out, forward, emit, move


def fit(rows: list[tuple[str, str]], *, words: int = 150_000, epochs: int = 3, run: int = 12, length: int = 48, rate: float = 0.5) -> dict | None:
    """Model from (text, language) rows; deterministic.  At most ``words`` words are learned from."""
    rows = [(words_of(text), lang) for text, lang in sorted(rows, key=lambda r: crc32(r[0].encode()))]
    labels = sorted({lang for w, lang in rows if w})
    if not labels:
        return None
    number = {lang: k for k, lang in enumerate(labels)}
    k = len(labels)
    pool: list[list[list[str]]] = [[] for _ in labels]  # runs of words by language
    counts: dict[str, np.ndarray] = {}
    held = [0] * k
    for ws, lang in rows:
        label = number[lang]
        if held[label] >= words // k:
            continue
        held[label] += len(ws)
        for w in ws:
            counts.setdefault(w, np.zeros(k))[label] += 1
        pool[label] += [ws[i : i + run] for i in range(0, len(ws), run)]
    share = np.array([max(1, h) for h in held], float)
    lexicon = {}
    for w, c in counts.items():
        if c.sum() >= 5:
            rates = (c + 0.1) / share
            lexicon[w] = (rates / rates.sum()).astype(np.float32)
    grams = frozenset(g for w in counts for g in grams_of(w))
    chance = np.random.default_rng(7)
    model = {
        "labels": labels, "lexicon": lexicon, "grams": grams, "weights": np.zeros((1 << BITS, k), np.float32),
        "lexicon_weights": np.ones(k), "transition": np.zeros((k, k)), "start": np.zeros(k),
    }
    squares = np.full((1 << BITS, k), 1e-3, np.float32)
    sequences: list[list[tuple[str, int]]] = []
    runs = [(r, label) for label in range(k) for r in pool[label]]
    # mostly a few runs of one language in a row, so that staying is likelier than switching
    cursor = [0] * k
    left = len(runs)
    while left:
        current: list[tuple[str, int]] = []
        while len(current) < length and left:
            label = int(chance.choice(k, p=_normal(np.array([len(pool[x]) - cursor[x] for x in range(k)], float))))
            for _ in range(int(chance.integers(1, 4))):
                if cursor[label] < len(pool[label]):
                    current += [(w, label) for w in pool[label][cursor[label]]]
                    cursor[label] += 1
                    left -= 1
        sequences.append(current)
    size = 64
    features = {w: features_of(w) for w in counts}
    for epoch in range(epochs):
        step = rate / (1 + epoch)
        order = chance.permutation(len(sequences))
        for at in range(0, len(order), size):
            some = [sequences[i] for i in order[at : at + size]]
            flat = [x for s in some for x in s]
            lengths = np.array([len(s) for s in some])
            gold = np.array([label for _, label in flat])
            distinct = sorted({w for w, _ in flat})
            place = {w: i for i, w in enumerate(distinct)}
            which = np.array([place[w] for w, _ in flat])
            scores = word_scores(distinct, model, [features[w] for w in distinct])[which]
            p, forward, emit, move = forward_backward(scores, lengths, model["transition"], model["start"])
            gap = p.copy()
            gap[np.arange(len(gold)), gold] -= 1
            by_word = np.zeros((len(distinct), k))
            np.add.at(by_word, which, gap)
            found = [features[w] for w in distinct]
            sizes = np.array([len(f) for f in found])
            ids = np.fromiter((x for f in found for x in f), np.int64, int(sizes.sum()))
            touched, inverse = np.unique(ids, return_inverse=True)
            grad = np.zeros((len(touched), k))
            np.add.at(grad, inverse, np.repeat(by_word / np.sqrt(sizes)[:, None], sizes, axis=0))
            grad = grad / len(flat) * 50 + 1e-4 * model["weights"][touched]
            squares[touched] += grad**2
            model["weights"][touched] -= (step * grad / np.sqrt(squares[touched])).astype(np.float32)
            begin = np.cumsum(lengths) - lengths
            inner = np.ones(len(flat), bool)
            inner[begin] = False
            inner = np.flatnonzero(inner)
            # expected moves of neighbouring words, against the observed ones
            after = emit * p / np.maximum(forward, 1e-300)
            joint = forward[inner - 1][:, :, None] * move[None] * after[inner][:, None, :]
            joint = (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            seen = np.zeros((k, k))
            np.add.at(seen, (gold[inner - 1], gold[inner]), 1)
            model["transition"] -= step * (joint - seen) / max(1, len(inner)) * 5
            start = np.bincount(gold[begin], minlength=k)
            model["start"] -= step * (p[begin].sum(axis=0) - start) / len(begin)
    return model | {"key": crc32(model["weights"].tobytes())}


def train(labelled: DataFrame, *, per_language: int = 300, row_words: int = ROW_WORDS, **settings) -> dict | None:
    """Fit on about ``per_language`` rows of each lang of ``labelled`` (doc_id, text, lang), chosen by hash.

    Of a chosen row the first ``row_words`` words reach the driver, of at most 40
    letters each, so what it holds is bounded in bytes whatever the texts.
    """
    usable = labelled.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    usable = usable.where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
    counts = usable.groupBy("lang").count().collect()  # one row per language
    if not counts:
        return None
    span = 1 << 30
    limit = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(span, span * per_language // r["count"])))])
    # the text is part of the hash: rows that repeat a doc_id are drawn one by one
    drawn = usable.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(span)) < limit[F.col("lang")])

    def shorten(batches):
        for batch in batches:
            words = [" ".join(words_of(t.as_py())[:row_words]) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), batch.column(1)], names=["text", "lang"])

    rows = drawn.select("text", "lang").mapInArrow(shorten, "text string, lang string").collect()  # about per_language of each language
    return fit([(r.text, r.lang) for r in rows], **settings)


def label_texts(texts: pa.Array, model: dict | None) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; words met before are scored once per worker."""
    return _label(texts, model)[:2]


def _label(texts: pa.Array, model: dict | None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and share of known words of each text."""
    langs, scores, known = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts)), np.zeros(len(texts))
    if model is None:
        return langs.tolist(), scores, known
    memory = kept("language_words", dict)
    if memory.get("of") != model["key"] or len(memory["place"]) > 500_000:
        memory |= {"of": model["key"], "place": {}, "scores": np.empty((0, len(model["labels"]))), "known": np.empty(0, bool)}
    place = memory["place"]
    split = [words_of(t) for t in texts.to_pylist()]
    lengths = np.array([len(s) for s in split], np.int64)
    some = np.flatnonzero(lengths)
    if len(some):
        new = list({w for s in split for w in s if w not in place})
        if new:
            place.update(zip(new, range(len(place), len(place) + len(new))))
            memory["scores"] = np.concatenate([memory["scores"], word_scores(new, model)])
            memory["known"] = np.concatenate([memory["known"], [is_known(w, model) for w in new]]).astype(bool)
        which = np.fromiter((place[w] for s in split for w in s), np.int64, int(lengths.sum()))
        p = marginals(memory["scores"][which], lengths[some], model["transition"], model["start"])
        mean = np.add.reduceat(p, np.cumsum(lengths[some]) - lengths[some], axis=0) / lengths[some][:, None]
        langs[some] = np.array(model["labels"], object)[mean.argmax(axis=1)]
        scores[some] = np.clip(mean.max(axis=1), 0, 1)
        known[some] = np.add.reduceat(memory["known"][which], np.cumsum(lengths[some]) - lengths[some]) / lengths[some]
    return langs.tolist(), scores, known


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, lang_pred, score per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed number of weights and a bounded lexicon

    def label(batches):
        for batch in batches:
            for a, b in bounded_slices(batch.column(1), 2_000_000):
                langs, scores = label_texts(batch.column(1)[a:b], shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array(langs, pa.string()), pa.array(scores)],
                    names=["doc_id", "lang_pred", "score"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(label, PREDICTED)


def held_out(doc_id: Column | str) -> Column:
    """Whether crc32 of the doc_id as text leaves 1 by 3; false for null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, *, per_language: int = 300) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that are not held out."""
    model = train(docs.where(~held_out("doc_id")), per_language=per_language)
    return predict(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, *, per_language: int = 300, least: float = 0.3) -> DataFrame:
    """``docs`` without the documents in no language the model has learned.

    A document stays if it has a language and at least ``least`` of its words are known:
    seen often in training, or made of trigrams nearly all of which were.  That does
    not depend on how many languages there are, unlike the best one's probability.
    """
    model = train(docs.where(~held_out("doc_id")), per_language=per_language)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed number of weights, bounded lexicon and trigrams
    text = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            for a, b in bounded_slices(batch.column(text), 2_000_000):
                langs, _, known = _label(batch.column(text)[a:b], shared.value)
                yield batch[a:b].filter(pa.array([lang != UNKNOWN and k >= least for lang, k in zip(langs, known)]))

    return docs.mapInArrow(keep, docs.schema)
