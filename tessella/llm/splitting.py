"""Splitting oversized items at natural boundaries (problem 4)."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sentences or lines on either side of a boundary whose words are compared.
BLOCK = 3
#: A piece is at least this share of its limit long where a boundary allows it.
FILL = 0.5

_GAP = re.compile(r"[.!?…]+[\"'»”’)\]*_]*(?=\s)|\r?\n\s*|\r")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\w{3,}")


def boundaries(text: str) -> list[int]:
    """Where sentences and lines end, ascending; the end of the text is not one of them."""
    out = []
    for m in _GAP.finditer(text):
        at = m.start() if text[m.start()] in "\r\n" else m.end()
        if 0 < at < len(text) and (not out or at > out[-1]) and not text[out[-1] if out else 0 : at].isspace():
            out.append(at)
    return out


def depths(text: str, ends: list[int]) -> list[float]:
    """How deep a valley of lexical cohesion each boundary is in.

    Similarity at a boundary is the cosine of word counts of the BLOCK sentences before and after it; its depth is how
    far similarity climbs on either side. Linear in the text.
    """
    counts = [Counter(w.lower() for w in _WORD.findall(text[a:b])) for a, b in zip([0, *ends], [*ends, len(text)])]
    similar = []
    for k in range(1, len(counts)):
        left, right = Counter(), Counter()
        for x in counts[max(0, k - BLOCK) : k]:
            left.update(x)
        for x in counts[k : k + BLOCK]:
            right.update(x)
        if len(left) > len(right):
            left, right = right, left
        dot = sum(n * right[w] for w, n in left.items() if w in right)
        norm = math.sqrt(sum(n * n for n in left.values()) * sum(n * n for n in right.values()))
        similar.append(dot / norm if norm else 0.0)
    climb_left, climb_right = list(similar), list(similar)
    for k in range(1, len(similar)):
        if similar[k - 1] >= similar[k]:
            climb_left[k] = climb_left[k - 1]
    for k in range(len(similar) - 2, -1, -1):
        if similar[k + 1] >= similar[k]:
            climb_right[k] = climb_right[k + 1]
    return [climb_left[k] + climb_right[k] - 2 * similar[k] for k in range(len(similar))]


def spans(text: str, max_chars: int, overlap: int) -> list[tuple[int, int, str]]:
    """Pieces of a text as (begin, end, kind of end), in order.

    Each piece has at most max_chars code points; each next piece begins `overlap` before the end of the one before it
    (at most max_chars - 1). A piece ends at the boundary in the deepest valley between FILL of the limit and the limit
    (kind `topic`; of equal depths the furthest); where there is none, at the last boundary before that (`sentence`),
    else at the last white space (`word`), else at the limit (`hard`), where no mark is parted from its letter if that
    can be. The last ends with the text (`end`). A text within the limit is one piece; an empty one none.
    """
    if not text:
        return []
    if len(text) <= max_chars:
        return [(0, len(text), "end")]
    overlap = max(0, min(overlap, max_chars - 1))
    ends = boundaries(text)
    valley = depths(text, ends)
    out: list[tuple[int, int, str]] = []
    begin = at = 0  # ends[:at] are passed
    while len(text) - begin > max_chars:
        low, fill, high = begin + overlap + 1, begin + max(overlap + 1, int(max_chars * FILL)), begin + max_chars
        while at < len(ends) and ends[at] < low:
            at += 1
        best, kind, k = -1, "topic", at
        last = -1
        while k < len(ends) and ends[k] <= high:
            if ends[k] >= fill and (best < 0 or valley[k] >= valley[best]):
                best = k
            last = k
            k += 1
        if best >= 0:
            end = ends[best]
        elif last >= 0:
            end, kind = ends[last], "sentence"
        else:
            end, kind = _word_end(text, low, high)
        out.append((begin, end, kind))
        begin = end - overlap
    out.append((begin, len(text), "end"))
    return out


def _word_end(text: str, low: int, high: int) -> tuple[int, str]:
    for at in range(high, low - 1, -1):
        if text[at].isspace() and not text[at - 1].isspace():
            return at, "word"
    for at in range(high, max(low, high - 32) - 1, -1):
        if not (unicodedata.combining(text[at]) or text[at] in "‍️" or text[at - 1] == "‍" or (text[at - 1] == "\r" and text[at] == "\n")):
            return at, "hard"
    return high, "hard"


def latest(artifacts: DataFrame, limits: DataFrame) -> DataFrame:
    """Artifacts whose content as last delivered is longer than the limit of their type: one row each.

    Columns artifact_id, artifact_type, content, heading_path, source_file, max_chars, overlap_chars. Of deliveries at
    the same time the longest, then the greatest content counts; null times come first. Null contents, null types and
    types without limit are never too long. Extra columns are left out.

    Contents within the limit are dropped before the shuffle that finds the last delivery, so it moves the few long ones.
    """
    bound = limits.filter("max_chars > 0").groupBy("artifact_type").agg(F.min(F.struct("max_chars", F.coalesce("overlap_chars", F.lit(0)).alias("overlap_chars"))).alias("limit"))
    sized = artifacts.select("artifact_id", "artifact_type", "delivered_at", "content", F.col("source.heading_path").alias("heading_path"), F.col("source.source_file").alias("source_file"), F.length("content").alias("n")).join(bound, "artifact_type", "left")
    is_long = F.coalesce(F.col("n") > F.col("limit.max_chars"), F.lit(False))
    kept = {c: F.when(is_long, F.col(c)) for c in ("content", "heading_path", "source_file", "limit")}
    slim = sized.select("artifact_id", "delivered_at", "artifact_type", F.coalesce("n", F.lit(0)).alias("n"), *(v.alias(k) for k, v in kept.items()))
    last = slim.groupBy("artifact_id").agg(F.max(F.struct("delivered_at", "n", "content", "artifact_type", "heading_path", "source_file", "limit")).alias("x"))
    return last.filter("x.content is not null").select("artifact_id", "x.artifact_type", "x.content", "x.heading_path", "x.source_file", "x.limit.max_chars", "x.limit.overlap_chars")


def split_oversized(artifacts: DataFrame, limits: DataFrame) -> DataFrame:
    """Pieces within the limit of every artifact that is longer, each with its artifact, heading path and source.

    Columns artifact_id, artifact_type, piece, n_pieces, begin, end, ends_at, content, heading_path, source_file. See
    `latest` for which content counts and `spans` for where it is cut. Pieces of one artifact, overlaps taken off, give
    its content again.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, rows = [], []
            for at in range(batch.num_rows):
                text = batch.column(2)[at].as_py()
                parts = spans(text, batch.column(5)[at].as_py(), batch.column(6)[at].as_py())
                take.extend([at] * len(parts))
                rows.extend((k, len(parts), a, b, kind, text[a:b]) for k, (a, b, kind) in enumerate(parts, 1))
            index = pa.array(take, pa.int32())
            own = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(index), batch.column(1).take(index), *own, batch.column(3).take(index), batch.column(4).take(index)], ["artifact_id", "artifact_type", "piece", "n_pieces", "begin", "end", "ends_at", "content", "heading_path", "source_file"])

    return latest(artifacts, limits).mapInArrow(
        cut, "artifact_id string, artifact_type string, piece int, n_pieces int, begin int, end int, ends_at string, content string, heading_path array<string>, source_file string"
    )
