"""Token counts under a unigram model, computed on a trie of distinct pre-tokens.

A pre-token is a word with a mark for the blank before it.  The best segmentation
of a prefix depends on the prefix only, so pre-tokens are inserted in a trie whose
nodes hold the forward score of their prefix (best sum of log probabilities) and
its number of pieces: a shared prefix is scored once, and the end node of a
pre-token holds its count.  Of equal scores the one with fewer pieces counts.
Beyond ``DENSE`` characters an edge of the trie is a run of ``RUN`` of them, so an
endless word without blanks needs a node per run, not per character.

The pieces are those of a public vocabulary, in its order; a piece of rank r has
probability proportional to 1 / (r + ``shift``), as frequencies by rank fall off.
A character without a piece costs one piece per byte at the probability of the
last rank.

Null or empty text: no pre-tokens, 0 tokens, score 0.  Repeated rows and ids are
counted alike.  Empty table: empty result.  Other columns are ignored.  Long texts
are counted whole, in portions of ``PORTION`` characters cut at blanks, between which
a trie that has grown too large is emptied.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.llm.worker import bounded_slices, kept

DEFAULT_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
COUNTED = "doc_id long, n_pretokens long, n_tokens long, score double"


def load_scores(path: str, shift: float = 3.0) -> dict[str, float]:
    """piece -> log probability; the key "" holds that of one unknown byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))
    ]
    weights = [1 / (rank + shift) for rank in range(len(pieces))]
    total = math.log(sum(weights))
    scores = {p: math.log(w) - total for p, w in zip(pieces, weights)}
    return scores | {"": math.log(weights[-1]) - total}


DENSE, RUN = 256, 256
PORTION = 250_000
_BLANK = re.compile(r"\s")
SPAN = 0x110000  # a child is found by node * SPAN + code point: plain numbers need no garbage collection


class Trie:
    """Nodes as numbers.

    A node also holds the pieces that are begun but not ended there, in threes:
    score and count where they began, and how far into the vocabulary's trie they are.
    """

    def __init__(self, scores: dict[str, float], most_nodes: int = 500_000):
        self.most_nodes = most_nodes
        self.byte = scores[""]
        self.piece_child: dict[int, int] = {}
        self.piece_score: list[float | None] = [None]
        self.goes_on: list[bool] = [True]
        for piece, score in scores.items():
            if piece:
                at = 0
                for char in map(ord, piece):
                    self.goes_on[at] = True
                    key = at * SPAN + char
                    if key not in self.piece_child:
                        self.piece_child[key] = len(self.piece_score)
                        self.piece_score.append(None)
                        self.goes_on.append(False)
                    at = self.piece_child[key]
                self.piece_score[at] = score
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.runs: dict[tuple[int, str], int] = {}
        self.score = [0.0]
        self.count = [0]
        self.begun: list[tuple] = [(0.0, 0, 0)]
        self.end_count: dict[str, int] = {}
        self.end_score: dict[str, float] = {}

    def insert(self, word: str) -> int:
        """End node of ``word``; nodes that are not there yet get their forward score."""
        node, child = 0, self.child
        for char in map(ord, word[:DENSE]):
            after = child.get(node * SPAN + char)
            if after is None:
                after = child[node * SPAN + char] = self._add(*self._extend(self._state(node), char))
            node = after
        for at in range(DENSE, len(word), RUN):
            run = word[at : at + RUN]
            after = self.runs.get((node, run))
            if after is None:
                state = self._state(node)
                for char in map(ord, run):
                    state = self._extend(state, char)
                after = self.runs[node, run] = self._add(*state)
            node = after
        return node

    def _state(self, node: int) -> tuple[float, int, tuple]:
        return self.score[node], self.count[node], self.begun[node]

    def _add(self, score: float, count: int, begun: tuple) -> int:
        self.score.append(score)
        self.count.append(count)
        self.begun.append(begun)
        return len(self.score) - 1

    def _extend(self, state: tuple[float, int, tuple], char: int) -> tuple[float, int, tuple]:
        """Score, number of pieces and begun pieces one character further."""
        best, fewest, begun = -math.inf, 0, ()
        child, weights = self.piece_child, self.piece_score
        score, pieces, open_ = state
        for k in range(0, len(open_), 3):
            to = child.get(open_[k + 2] * SPAN + char)
            if to is not None:
                weight = weights[to]
                if weight is not None:
                    total, count = open_[k] + weight, open_[k + 1] + 1
                    if total > best or total == best and count < fewest:
                        best, fewest = total, count
                if self.goes_on[to]:
                    begun += (open_[k], open_[k + 1], to)
        alone = child.get(char)
        if alone is None or weights[alone] is None:
            size = len(chr(char).encode())
            total, count = score + size * self.byte, pieces + size
            if total > best or total == best and count < fewest:
                best, fewest = total, count
        return best, fewest, begun + (best, fewest, 0)

    def count_text(self, text: str | None) -> tuple[int, int, float]:
        """Pre-tokens, tokens and score of a text."""
        n_words, n_tokens, scores = 0, 0, array("d")
        for portion in portions(text or ""):
            if len(self.score) + 2 * len(self.runs) > self.most_nodes:
                self.clear()  # bounds memory; scores are computed again
            words = portion.split()
            counts, weights = self.end_count, self.end_score
            for word in set(words).difference(counts):
                node = self.insert(MARK + word)
                counts[word], weights[word] = self.count[node], self.score[node]
            n_words += len(words)
            n_tokens += sum(map(counts.__getitem__, words))
            scores.extend(map(weights.__getitem__, words))
        return n_words, n_tokens, math.fsum(scores)


def portions(text: str, size: int = PORTION) -> Iterator[str]:
    """The text cut at the first blank after each ``size`` characters."""
    start = 0
    while len(text) - start > size and (gap := _BLANK.search(text, start + size)):
        yield text[start : gap.start()]
        start = gap.end()
    yield text[start:]


def count_tokens(docs: DataFrame, *, vocabulary: str = DEFAULT_VOCABULARY, shift: float = 3.0) -> DataFrame:
    """doc_id, n_pretokens, n_tokens, score per row of ``docs``."""

    def count(batches):
        tries = kept("unigram_tries", dict)
        if (vocabulary, shift) not in tries:
            tries[vocabulary, shift] = Trie(load_scores(vocabulary, shift))
        trie = tries[vocabulary, shift]
        for batch in batches:
            for a, b in bounded_slices(batch.column(1)):
                words, tokens, scores = zip(*map(trie.count_text, batch.column(1)[a:b].to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array(words, pa.int64()), pa.array(tokens, pa.int64()), pa.array(scores, pa.float64())],
                    names=["doc_id", "n_pretokens", "n_tokens", "score"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, COUNTED)
