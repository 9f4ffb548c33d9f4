"""What tells an unfilled template field from other things between signs: a model of the classes of its characters.

A span is written in classes (runs of small letters, of capitals, digits, blanks, the letter X by itself, signs as they
are); grams of these classes and the words of the span are features, whose weights, the log odds of a field, are learnt from
examples that `phrases` generates. Spans have no limit of length: long runs of words count as one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

from tessella.llm import phrases

#: Signs that open a span and those that close it.
PAIRS = {"{": "}", "[": "]", "<": ">", "«": "»", "“": "”", "(": ")"}
#: Signs that stand on both sides of a span.
TWINS = ("%%", "@@", "$$", "__", "#")
_WORD = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"X+(?![^\W\d_])|[^\W\d_]+|\d+|[\s_]+|[^\w\s]")
_CROSSES = re.compile(r"(?:(?<![^\W\d_])|(?<=\d))X{2,}(?![^\W\d_])")
_LINE = re.compile(r"[\n\r\0]")


def classes(span: str) -> list[str]:
    """The classes of a span, many words in a row as one: w and w+ for small letters, W and W+ for
    capitals, V for a short word in capitals."""
    out: list[str] = []
    for m in _RUN.finditer(span):
        t = m.group()
        k = "X" if t.strip("X") == "" else ("w" if not t.isupper() or len(t) < 2 else "W" if len(t) > 3 else "V") if t[0].isalpha() else "0" if t[0].isdigit() else " " if t[0].isspace() or t[0] == "_" and len(t) == 1 else t
        # Words and blanks between the first word and the last are one run.
        if k in "wWV" and len(out) > 1 and out[-1] == " " and out[-2][0] in "wWV":
            out.pop()
            out[-1] = ("w" if "w" in (k, out[-1][0]) else "W") + "+"
        else:
            out.append(k)
    # Blanks beside brackets and other signs say nothing.
    return [k for i, k in enumerate(out) if k != " " or (0 < i < len(out) - 1 and out[i - 1][0] in "wWVX0:" and out[i + 1][0] in "wWVX0")]


def features(span: str) -> set[str]:
    """Grams of up to four classes with the edges, and words without case."""
    c = ["^", *classes(span), "$"]
    grams = {"c:" + "\x1f".join(c[i : i + n]) for n in (2, 3, 4) for i in range(len(c) - n + 1)}
    return grams | {"w:" + w.lower() for w in _WORD.findall(span)}


_SIGN = re.compile(r"[\[\]{}<>()«»“”]")
_GAP = re.compile(r"\s*(?:[/.,-]|de|of)?\s*(?:\d\d)?")
_CLOSING = {v: k for k, v in PAIRS.items()}


def spans(text: str, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """What may be fields in a line: text from an opening sign to the one that closes it, between twins, and runs of crosses."""
    open_at: list[int] = []
    for m in _SIGN.finditer(text, begin, end):
        at, c = m.start(), m.group()
        if c in PAIRS:
            open_at.append(at)
            continue
        while open_at and text[open_at[-1]] != _CLOSING[c]:
            open_at.pop()
        if open_at:
            a, b = open_at.pop(), at + 1
            # Doubled brackets and a sign before them belong to the span.
            while a > begin and b < end and PAIRS.get(text[a - 1]) == text[b]:
                a, b = a - 1, b + 1
            if a > begin and text[a - 1] in "$#%":
                a -= 1
            yield a, b
    for twin in TWINS:
        first = text.find(twin, begin, end)
        while first >= 0:
            second = text.find(twin, first + len(twin), end)
            if second < 0:
                break
            yield first, second + len(twin)
            first = second if second > first + len(twin) else text.find(twin, second + len(twin), end)
    if text.find("XX", begin, end) < 0:
        return
    crosses = [m.span() for m in _CROSSES.finditer(text, begin, end)]
    k = 0
    while k < len(crosses):
        j = k
        while j + 1 < len(crosses) and _GAP.fullmatch(text, crosses[j][1], crosses[j + 1][0]):
            j += 1
        if j > k:
            yield crosses[k][0], crosses[j][1]
        k = j + 1


#: What a gram of classes weighs that no example has, weight decay and steps of the regression.
UNSEEN, DECAY, STEPS = 1.5, 2e-4, 600


def fitted() -> dict[str, float]:
    """Weights of features by logistic regression on the examples of `phrases`; `bias` is one of them.

    Each form counts alike, however many names it is written with.
    """
    weight: dict[tuple[bool, frozenset], float] = {}
    for is_field, groups in ((True, phrases.field_groups()), (False, phrases.other_groups())):
        groups = [list(g) for g in groups]
        for group in groups:
            for example in group:
                key = is_field, frozenset(features(example))
                weight[key] = weight.get(key, 0.0) + 1 / len(groups) / len(group)
    names = sorted(set().union(*(fs for _, fs in weight)))
    at = {f: k for k, f in enumerate(names)}
    y, w = np.array([k for k, _ in weight], np.float64), np.array(list(weight.values()))
    # The rows of the design, each a run of columns that are 1; the last column is the bias.
    runs = [[*(at[f] for f in fs), len(names)] for _, fs in weight]
    columns, sizes = np.concatenate(runs), np.array([len(r) for r in runs])
    starts, rows = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(runs)), sizes)
    beta, speed = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(np.add.reduceat(beta[columns], starts), -30, 30)))
        speed = 0.9 * speed - np.bincount(columns, (w * (p - y))[rows], len(beta)) - DECAY * beta
        beta += 0.5 * speed
    return {**dict(zip(names, beta.tolist())), "bias": float(beta[-1])}


class FieldModel:
    """Judges spans by weights of fitted().

    A gram of classes that no example has speaks against a field by UNSEEN, since forms are strict; words that no example
    has say nothing.
    """

    def __init__(self, weights: dict[str, float]) -> None:
        self.weights = weights
        self._scores: dict[str, float] = {}

    def score(self, span: str) -> float:
        """Log odds that a span is a field: above 0 it is one."""
        known = self._scores.get(span)
        if known is None:
            if len(self._scores) > 50_000:
                self._scores.clear()
            known = self.weights.get("bias", 0.0)
            for f in features(span):
                w = self.weights.get(f)
                known += w if w is not None else -UNSEEN if f[0] == "c" else 0.0
            self._scores[span] = known
        return known

    def in_window(self, text: str, begin: int, end: int, a: int, b: int) -> bool:
        """Whether a span that touches a window [a, b) of the text [begin, end) is a field."""
        low = max(begin, *(text.rfind(c, begin, a) + 1 for c in "\n\r"))
        high = _LINE.search(text, min(b, end), end)
        high = high.start() if high else end
        return any(x < b and y > a and self.score(text[x:y]) > 0 for x, y in spans(text, low, high))
