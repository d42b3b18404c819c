"""Token ids of whole texts from a public tokenizer file.

The tokenizers library needs about 0.7 s for a megabyte.  A byte-level BPE with
this pre-tokenizer never joins a single blank to the word before it, so a text
may be cut before each single blank and the parts encoded on their own.  Every
distinct part goes through the library once per worker and its ids are reused.
"""

from __future__ import annotations

import os
import re
from array import array

import public_tokenizers

from specflow.llm.worker import kept

DEFAULT_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

_RUN = re.compile(r"\s\s")
_SINGLE_BLANK = re.compile(r"(?<=\S) (?=\S)")
_ENDS = frozenset(",.;:!?")


def parts_of(text: str) -> list[str]:
    """Pieces that encode independently; all but the first stand for blank + piece, or begin with a line end."""
    if _RUN.search(text):
        return _SINGLE_BLANK.split(text)
    return text.replace("\n", " \n").split(" ")  # a part that begins with a line end has no blank before it


class Parts(dict):
    """part -> ids of ``before`` + part as little-endian unsigned 32-bit integers."""

    def __init__(self, tokenizer, before: str, alphabet: list[str], bare: Parts | None = None):
        super().__init__()
        self.tokenizer, self.before, self.bare = tokenizer, before, bare
        self.model, self.alphabet = tokenizer.model, alphabet
        self.ends = {mark: self._word(mark) for mark in _ENDS}

    def _word(self, text: str) -> bytes:
        """Ids of a text that is one pre-token: straight to the merges."""
        shown = text.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def __missing__(self, part: str) -> bytes:
        if part.isalpha():
            ids = self._word(self.before + part)
        elif part[-1:] in _ENDS and part[:-1].isalpha():
            ids = self[part[:-1]] + self.ends[part[-1]]
        elif self.bare is not None and part[:1] == "\n":
            ids = self.bare["\n"] + (self.bare[part[1:]] if len(part) > 1 else b"")
        else:
            ids = array("I", self.tokenizer.encode(self.before + part, add_special_tokens=False).ids).tobytes()
        self[part] = ids
        return ids


def _shown_bytes() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Encoder:
    """Texts -> ids as bytes.

    ``keep`` bounds the memory of remembered parts; beyond it they are forgotten
    and encoded again, which changes no result.
    """

    def __init__(self, path: str, keep: int = 700_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keep = keep
        shown = _shown_bytes()
        self.first = Parts(self.tokenizer, "", shown)
        self.later = Parts(self.tokenizer, " ", shown, self.first)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.later) + len(self.first) > self.keep:
            self.later.clear()
            self.first.clear()
        out = []
        for text in texts:
            if text:
                parts = parts_of(text)
                out.append(self.first[parts[0]] + b"".join(map(self.later.__getitem__, parts[1:])))
            else:
                out.append(b"")
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, read once."""
    encoders = kept("encoders", dict)
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]
