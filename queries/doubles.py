"""Stand-ins for a model: the reply is a fixed function of md5(prompt).

They are fixtures for checking results, not models; SQL can compute the same.
"""

from __future__ import annotations

import hashlib
import json

from specflow.operators.columns import CRITERIA
from specflow.operators.inference import ModelCall


def _digest(messages) -> str:
    return hashlib.md5(messages[-1]["content"].encode()).hexdigest()


def writer():
    """Answers every prompt with two numbered tasks."""

    def chat(model, messages, options, format):
        d = _digest(messages)
        return (
            f"1. summary: Build {d[:8]}\ndescription: First {d[8:16]}\n\n"
            f"2. summary: Test {d[16:24]}\ndescription: Second {d[24:]}"
        )

    return chat


def short_writer():
    """Answers every prompt with one unnumbered sentence."""

    def chat(model, messages, options, format):
        return "Only " + _digest(messages)[:12]

    return chat


def single_judge():
    """Scores criterion i with the i-th hex digit modulo 11; no approval of its own."""

    def chat(model, messages, options, format):
        d = _digest(messages)
        return json.dumps({c: {"puntuacion": int(d[i], 16) % 11} for i, c in enumerate(CRITERIA)})

    return chat


def pair_judge():
    """Scores A from the first five hex digits, B from the next five; the 11th decides."""

    def chat(model, messages, options, format):
        d = _digest(messages)
        reply = {}
        for i, c in enumerate(CRITERIA):
            reply[f"{c}_a"] = int(d[i], 16) % 11
            reply[f"{c}_b"] = int(d[5 + i], 16) % 11
        reply["winner"] = "B" if int(d[10], 16) % 2 else "A"
        reply["reason"] = d[11:16]
        return json.dumps(reply)

    return chat


def shower():
    """Repeats the request; fails always, or at first, for some prompts.

    The digest decides, and how often this worker was asked is counted here.
    """
    asked: dict[str, int] = {}

    def chat(model, messages, options, format):
        d = _digest(messages)
        asked[d] = asked.get(d, 0) + 1
        if d[0] == "0":
            raise RuntimeError("never " + d[1:5])
        if d[0] == "1" and asked[d] % 2:
            raise RuntimeError("not yet")
        system = messages[0]["content"] if messages[0]["role"] == "system" else "none"
        return f"{model}|{system}|{options['temperature']}|{format}|{d[:6]}"

    return chat


def failing_judge():
    """No answer for prompts whose digest begins with 0 to 3, no JSON for 4 and 5."""

    def chat(model, messages, options, format):
        d = _digest(messages)
        if d[0] in "0123":
            raise RuntimeError("down " + d[1:4])
        if d[0] in "45":
            return "no idea"
        if model == "pair":
            return json.dumps({"coherence_a": 5, "granularity_b": 4, "winner": "B", "reason": f"{format}{options['num_predict']}"})
        return json.dumps({c: {"puntuacion": 8} for c in CRITERIA})

    return chat


SHOWER = ModelCall(shower, "m", system="be brief", options={"temperature": 0.5}, response_format="json", max_retries=1, backoff=0.0)
FAILING_JUDGE = ModelCall(failing_judge, "single", workers=4, max_retries=0)
FAILING_PAIR_JUDGE = ModelCall(failing_judge, "pair", workers=4)
WRITER = ModelCall(writer, "double-writer", workers=4, backoff=0.0)
SHORT_WRITER = ModelCall(short_writer, "double-short", workers=4, backoff=0.0)
SINGLE_JUDGE = ModelCall(single_judge, "double-judge", workers=4, backoff=0.0)
PAIR_JUDGE = ModelCall(pair_judge, "double-pair-judge", workers=4, backoff=0.0)
