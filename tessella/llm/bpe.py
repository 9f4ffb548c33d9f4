"""Exact byte-pair encoding without running merges: matching automaton, pair compatibility, bounded lookahead.

An encoding of a text is a chain of tokens. The encoding of every prefix ends with exactly one token, and a token may
follow another only if encoding the two together leaves both as they are (`compatible`). So one pass of an automaton
over the bytes finds, for each prefix, the longest token that ends there and is compatible with the last token of the
prefix before it. That gives the count of tokens in linear time without making ids, and, as a transducer, the ids: a
token is settled as soon as the chains of all prefixes in the last `window` bytes share it, for no later token can
begin before those. `window`, the lookahead, follows from the merge list: it is the length of its longest token.
"""

from __future__ import annotations

import base64
import codecs
import json
from collections.abc import Iterable, Iterator

import ahocorasick
import regex

#: Most pieces kept with their result in one worker. The memo is emptied when full; results do not depend on it.
MEMO_PIECES = 200_000

#: Characters from which on a text is split while it is encoded; results do not depend on it.
LONG = 200_000


def _byte_alphabet() -> dict[str, int]:
    """Characters by which a vocabulary in JSON writes bytes: printable ones as themselves, others moved up from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(moved)}


class MergeTable:
    """A merge list: tokens, the two parts of each, and ids of pairs that merge."""

    def __init__(self, tokens: list[bytes], parts: dict[int, tuple[int, int]]):
        self.tokens = tokens
        self.rank: dict[bytes, int] = {t: i for i, t in enumerate(tokens)}
        self.left = [parts[i][0] if i in parts else i for i in range(len(tokens))]
        self.right = [parts[i][1] if i in parts else i for i in range(len(tokens))]
        self.merged = {pair: i for i, pair in parts.items()}
        self.window = max(map(len, tokens))
        self._ok: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(tokens):
            self.automaton.add_word(t.decode("latin-1"), (i, len(t)))
        self.automaton.make_automaton()

    @classmethod
    def parse(cls, raw: bytes) -> MergeTable:
        """From the content of a vocabulary file: JSON with merges, or base64 tokens with ranks."""
        if raw.lstrip()[:1] == b"{":
            model = json.loads(raw)["model"]
            alphabet = _byte_alphabet()
            vocab = model["vocab"]
            tokens = [b""] * len(vocab)
            for text, i in vocab.items():
                tokens[i] = bytes(alphabet[c] for c in text)
            pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
            return cls(tokens, {vocab[a + b]: (vocab[a], vocab[b]) for a, b in pairs})
        rows = sorted((int(rank), base64.b64decode(token)) for token, rank in (x.split() for x in raw.splitlines() if x))
        tokens = [t for _, t in rows]
        rank = {t: i for i, t in enumerate(tokens)}
        return cls(tokens, {i: _parts(t, rank, i) for i, t in enumerate(tokens) if len(t) > 1})

    def compatible(self, a: int, b: int) -> bool:
        """Whether the bytes of token a and then of token b encode as just these two tokens.

        Undoes merges on both sides of the boundary, the latest first, and looks for a merge across it that would have
        come earlier than the merges that were undone.
        """
        known = self._ok.get((a, b))
        if known is None:
            if len(self._ok) > 1_000_000:
                self._ok.clear()
            known = self._ok[a, b] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        left, right, merged = self.left, self.right, self.merged
        limit = len(self.tokens)
        while True:
            across = merged.get((a, b))
            if across is not None and across < limit:
                return False
            # The later of the two merges is undone first; of equals the right one, as merges run from the left.
            for side in ("a", "b") if a > b else ("b", "a"):
                if side == "a":
                    inner = right[a]
                    if inner != a:
                        limit, a = a, inner
                        break
                else:
                    inner = left[b]
                    if inner != b:
                        limit, b = b + 1, inner
                        break
            else:
                return True


def _parts(token: bytes, rank: dict[bytes, int], below: int) -> tuple[int, int]:
    """The last two parts of a token: merges of lower rank until two are left."""
    parts = [bytes([x]) for x in token]
    while len(parts) > 2:
        best = min(((rank.get(parts[k] + parts[k + 1], below), k) for k in range(len(parts) - 1)))
        if best[0] >= below:
            raise ValueError(f"token {below} cannot be reached by merges")
        k = best[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return rank[parts[0]], rank[parts[1]]


class Encoder:
    """Encodes and counts texts by a merge table, piece by piece of the pattern that splits text before merges."""

    def __init__(self, table: MergeTable, pattern: str):
        self.table = table
        self._pattern = regex.compile(pattern)
        self.ids_of = _Memo(lambda piece: tuple(self.stream([piece.encode("utf-8", "surrogatepass")])))
        self.count_of = _Memo(self.count_piece)

    def pieces(self, text: str) -> Iterable[str]:
        """The pieces of a text, of a long one one at a time, so that its pieces are never held together."""
        return self._pattern.findall(text) if len(text) < LONG else (m.group() for m in self._pattern.finditer(text))

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; none for an empty text and for null."""
        out: list[int] = []
        for piece in self.pieces(text or ""):
            out.extend(self.ids_of[piece])
        return out

    def count(self, text: str | None) -> int:
        """How many ids encode() gives."""
        return sum(map(self.count_of.__getitem__, self.pieces(text or "")))

    def count_piece(self, piece: str) -> int:
        """Tokens of one piece, without ids of them: the length of the chain at each prefix."""
        data = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        last, length, ok = [-1], [0], self.table.compatible
        done = 0
        for end, (token, size) in self.table.automaton.iter(data):
            if end + 1 > done:
                before = last[end + 1 - size]
                if before < 0 or ok(before, token):
                    last.append(token)
                    length.append(length[end + 1 - size] + 1)
                    done = end + 1
        return length[-1]

    def stream(self, chunks: Iterable[bytes], lookahead: list[int] | None = None) -> Iterator[int]:
        """Ids of one piece that comes in chunks, each as soon as it is settled; memory doesn't grow with the piece.

        `lookahead`, if given, gets the number of bytes beyond its end that each check for settled tokens had kept.
        """
        table, window = self.table, self.table.window
        ok = table.compatible
        last = [-1]  # last[k] ends the encoding of the first base + k bytes; last[0] is settled
        base = 0
        walk = table.automaton.iter("")
        for chunk in chunks:
            for at in range(0, len(chunk), window):
                part = chunk[at : at + window]
                walk.set(part.decode("latin-1"))
                for end, (token, size) in walk:
                    if end + 2 > base + len(last):
                        begin = end + 1 - size - base
                        if begin >= 0 and (last[begin] < 0 or ok(last[begin], token)):
                            last.append(token)
                if len(last) > 2 * window:
                    settled = self._common(last, window)
                    yield from self._chain(last, settled)
                    if lookahead is not None:
                        lookahead.append(len(last) - 1 - settled)
                    del last[:settled]
                    base += settled
        yield from self._chain(last, len(last) - 1)

    def _common(self, last: list[int], window: int) -> int:
        """The furthest position through which the chains of the last `window` prefixes all pass."""
        sizes = self.table.tokens
        open_ends = set(range(len(last) - window, len(last)))
        while len(open_ends) > 1:
            far = max(open_ends)
            open_ends.discard(far)
            open_ends.add(far - len(sizes[last[far]]))
        return open_ends.pop()

    def _chain(self, last: list[int], end: int) -> list[int]:
        sizes, out = self.table.tokens, []
        while end > 0:
            out.append(last[end])
            end -= len(sizes[last[end]])
        out.reverse()
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids, by a decoder that keeps only the bytes of an unfinished character between tokens."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        return "".join([*(machine.decode(self.table.tokens[i]) for i in ids), machine.decode(b"", True)])


class _Memo(dict):
    """Results by piece; emptied when full."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, piece):
        if len(self) >= MEMO_PIECES:
            self.clear()
        value = self.of(piece)
        if len(piece) <= 64:
            self[piece] = value
        return value


_ENCODERS: dict[tuple[int, int, str], Encoder] = {}


def encoder(raw: bytes, pattern: str) -> Encoder:
    """The encoder of a vocabulary file's content, made once in each process."""
    key = (len(raw), hash(raw), pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(MergeTable.parse(raw), pattern)
    return _ENCODERS[key]
