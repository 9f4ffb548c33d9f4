"""Template residue, filler, error pages and notices instead of content (problem 8).

Character GRAM-gram models in hashed tables of fixed size: natural prose, counted over the distinct sentences and lines of
all texts, and Latin filler, other filler, notices and template fields, from the grammars of `phrases`. Log likelihood ratios against natural
prose, averaged over windows, localise residue. Further rounds run over the distinct sentences: what is mostly covered by
filler or notice windows is added to that model and taken out of natural prose, so that wordings beyond the grammars are
learnt from the corpus. A sentence counts once however many rows repeat it: repetition makes nothing natural.

A text is residue if a sentence or line of it is mostly covered by filler windows, if most of it is covered by notice
windows, or if a window of the field model or a rare sign leads to a span that `fields.FieldModel`, a likelihood ratio over the classes of
its signs and words, takes for a field.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import phrases
from tessella.llm.fields import FieldModel, fitted
from tessella.tables import cut_lineage, spread

#: Characters in a gram, and cells of the table that grams are hashed to: 4 MB in all, however large the corpus.
GRAM, CELLS = 4, 1 << 18
#: Grams in a window for filler and notices, and for fields.
WINDOW, FIELD_WINDOW = 10, 6
#: Mean log likelihood ratio from which a window is covered.
RATIO = 0.4
#: Share of a sentence or line under filler or notice windows, and share of a text in notice sentences, from which they count.
COVER, PAGE = 0.6, 0.5
#: Mean log likelihood ratio that a sentence or line has as a whole, of Latin, other filler and notices.
WHOLE = (0.4, 1.0, 0.6)
#: Stricter cover for what one round teaches the next, and how many rounds teach.
TEACH, ROUNDS = 0.75, 2
#: Characters that are scored at once.
BLOCK = 60_000

#: Code points with entries in the tables below: all below the ideographs; those above are letters to the models.
_MOST = 0x3000


def _flagged(*signs: str) -> np.ndarray:
    out = np.zeros(_MOST + 1, np.uint8)
    for bit, chars in enumerate(signs):
        out[[ord(c) for c in chars]] |= 1 << bit
    return out


_SPACES = "".join(map(chr, range(33))) + "\xa0"
#: What a character is: white space, the stop of a sentence, a line end, a sign that fields begin with, one that does if doubled, `:` or `;`.
_SPACE, _STOP, _LINE, _OPEN, _TWICE, _COLON = (1 << k for k in range(6))
_FLAGS = _flagged(_SPACES, ".!?…", "\n\r\0", "{[<«“#", "%@$_X", ":;")


def _folded() -> np.ndarray:
    c = np.arange(_MOST + 1, dtype=np.uint32)
    c[((c >= 65) & (c <= 90)) | ((c >= 0xC0) & (c <= 0xDE) & (c != 0xD7))] += 32
    c[(c >= 48) & (c <= 57)] = 48
    c[(c <= 32) | (c == 0xA0)] = 32
    return c


_FOLDED = _folded()


def _raw(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _fold(raw: np.ndarray) -> np.ndarray:
    """Code points without case of Latin letters, with one digit and one white space."""
    return np.where(raw < _MOST, _FOLDED[np.minimum(raw, _MOST)], raw)


def _flags(raw: np.ndarray) -> np.ndarray:
    return _FLAGS[np.minimum(raw, _MOST)]


def _cells(codes: np.ndarray) -> np.ndarray:
    """The cell of the gram that begins at each position but the last GRAM - 1."""
    if len(codes) < GRAM:
        return np.empty(0, np.uint32)
    h = np.zeros(len(codes) - GRAM + 1, np.uint32)
    for k in range(GRAM):
        h = h * np.uint32(0x9E3779B1) + codes[k : len(codes) - GRAM + 1 + k]
        h ^= h >> np.uint32(15)
    return h & np.uint32(CELLS - 1)


def _blocks(texts: Iterator[str | None]) -> Iterator[list[str]]:
    block, size = [], 0
    for text in texts:
        block.append(text or "")
        size += len(block[-1])
        if size > BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def _segments(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sentences and lines of texts end to end begin and end: a line ends at a line end or zero, a sentence at a stop
    before white space. White space around them and stops before them are not part of them."""
    space = (flags & _SPACE) > 0
    after = np.append(space[1:], True)
    cuts = np.flatnonzero(((flags & _LINE) > 0) | (((flags & _STOP) > 0) & after)) + 1
    begin, end = np.concatenate([[0], cuts[:-1]]) if len(cuts) else np.empty(0, np.int64), cuts
    solid, dark = np.flatnonzero((flags & (_SPACE | _STOP)) == 0), np.flatnonzero(~space)
    if not len(solid):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.searchsorted(solid, begin)
    begin = solid[np.minimum(at, len(solid) - 1)]
    kept = (at < len(solid)) & (begin < end)
    begin, end = begin[kept], end[kept]
    return begin, dark[np.searchsorted(dark, end) - 1] + 1


def _signs(raw: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Where a sign stands that fields begin with and prose seldom has: brackets other than round ones, doubled signs, crosses."""
    return ((flags & _OPEN) > 0) | (((flags & _TWICE) > 0) & np.append(raw[1:] == raw[:-1], False))


def _count(text: str) -> np.ndarray:
    return np.bincount(_cells(_fold(_raw(text))), minlength=CELLS)


def _ratio(own: np.ndarray, natural: np.ndarray) -> np.ndarray:
    """Log likelihood ratios of a class against natural prose, the class smoothed by natural prose at a third of its weight."""
    p = (natural + 0.5) / (natural.sum() + 0.5 * CELLS)
    weight = own.sum() / 3
    return np.log((own / p + weight) / (own.sum() + weight)).astype(np.float32)


def phrase_counts() -> np.ndarray:
    """Counts of the classes, Latin, other filler, notices and fields, from the grammars of `phrases`."""
    return np.stack([_count(phrases.latin_text()), _count(phrases.filler_text()), _count(phrases.notice_text()), _count(" ".join(phrases.fields()))]).astype(np.float64)


def _covered(scores: np.ndarray, window: int) -> np.ndarray:
    """Which positions lie in a window whose mean score reaches RATIO."""
    n = len(scores)
    window = min(window, n)
    if n == 0:
        return np.zeros(0, bool)
    total = _sums(scores)
    at = np.flatnonzero((total[window:] - total[:-window]) >= RATIO * window)
    marks = np.bincount(at, minlength=n + 1)[: n + 1] - np.bincount(at + window, minlength=n + 1)[: n + 1]
    return np.cumsum(marks[:-1]) > 0


def _sums(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(x, dtype=np.float64)])


@dataclass
class Model:
    """What fit() gives: ratio tables of the classes by cell, and the weights of features of fields."""

    tables: np.ndarray
    fields: dict[str, float]


class Scorer:
    """Scores texts by the ratio tables of the classes, many texts in one pass over arrays."""

    def __init__(self, model: Model):
        self.tables, self.fields = model.tables, FieldModel(model.fields)

    def block(self, texts: list[str], fields: bool = True):
        """Arrays over the sentences and lines of texts: owner, begin, end, cover by class, whether a stop ends it; and the
        texts that have a field. Texts are laid end to end; grams over the end of one lie in no covered window."""
        whole = "\0".join(texts) + "\0" * GRAM
        raw = _raw(whole)
        flags = _flags(raw)
        cells = _cells(_fold(raw))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        over = (starts[1:, None] - 1 - np.arange(GRAM)).ravel()
        over = over[(over >= 0) & (over < len(cells))]
        scores = [table[cells] for table in (self.tables if fields else self.tables[:-1])]
        totals = [_sums(s) for s in scores[: len(WHOLE)]]
        for s in scores:
            s[over] = -1e4
        covers = [_sums(_covered(s, WINDOW)) for s in scores[: len(WHOLE)]]
        begin, end = _segments(flags)
        owner = np.searchsorted(starts, begin, "right") - 1
        n = np.maximum(end - GRAM + 1 - begin, 0)
        kept = n > 0
        owner, begin, end, n = owner[kept], begin[kept], end[kept], n[kept]
        to = begin + n
        shares = np.stack([np.where(t[to] - t[begin] >= least * n, (cover[to] - cover[begin]) / n, 0.0) for t, cover, least in zip(totals, covers, WHOLE)])
        with_field: set[int] = set()
        if fields:
            near = _covered(scores[-1], FIELD_WINDOW)
            near |= _signs(raw, flags)[: len(near)]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], near.astype(np.int8), [0]])))
            owners = np.searchsorted(starts, edges[::2], "right") - 1
            for k, a, b in zip(owners.tolist(), edges[::2].tolist(), edges[1::2].tolist()):
                if k not in with_field and self.fields.in_window(whole, int(starts[k]), int(starts[k] + sizes[k]), a, b + 1):
                    with_field.add(k)
        return (owner, begin, end, shares, (flags[end - 1] & (_STOP | _COLON)) > 0), with_field

    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text whether it has a filler passage, is a notice page, has a template field."""
        (owner, begin, end, shares, stopped), with_field = self.block(texts)
        f, c = shares[:-1].max(0), shares[-1]
        many, size = len(texts), end - begin
        by_text = lambda where: np.bincount(owner[where], size[where], many)
        filler = by_text((f >= COVER) & (size >= 8)) > 0
        notice = by_text(c >= COVER)
        # Headings do not count: of a page only notice sentences and what ends as a sentence.
        page = (notice > 0) & (notice >= PAGE * by_text((c >= COVER) | stopped))
        field = np.zeros(many, bool)
        field[list(with_field)] = True
        return filler, page, field


def sentences(df: DataFrame) -> DataFrame:
    """The distinct sentences and lines of column text, without case, one digit for all: column piece."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(v.as_py() for v in batch.column(0)):
                raw = _raw("\0".join(block) + "\0")
                begin, end = _segments(_flags(raw))
                plain = _fold(raw).tobytes().decode("utf-32-le", "surrogatepass")
                yield pa.RecordBatch.from_arrays([pa.array(dict.fromkeys(plain[a:b] for a, b in zip(begin.tolist(), end.tolist())), pa.string())], ["piece"])

    return df.select("text").filter(F.col("text").isNotNull()).mapInArrow(split, "piece string").distinct()


def _counts(pieces: DataFrame, classes, width: int) -> np.ndarray:
    """Grams of sentences as `width` x CELLS counts; `classes` gives the class of each sentence of a block, -1 for none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, CELLS), np.int64)
        for batch in batches:
            for block in _blocks(v.as_py() for v in batch.column(0)):
                of = classes(block)
                for k in range(width):
                    own = [p for p, x in zip(block, of) if x == k]
                    if own:
                        # Each with a blank on both sides; the grams that reach into the next one are not counted.
                        lines = [f" {p} " for p in own]
                        cells = _cells(_fold(_raw("".join(lines))))
                        inside = np.ones(sum(map(len, lines)), bool)
                        inside[(np.cumsum([len(x) for x in lines])[:, None] - 1 - np.arange(GRAM - 1)).ravel()] = False
                        total[k] += np.bincount(cells[inside[: len(cells)]], minlength=CELLS)
        flat = total.reshape(-1)
        cells = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(flat[cells])], ["cell", "n"])

    rows = pieces.mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(width * CELLS, np.int64)
    out[rows["cell"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out.reshape(width, CELLS)


def fit(df: DataFrame) -> Model:
    """The model against the natural prose of column text of `df`.

    The texts are read once; the rounds run over their distinct sentences. What comes to the driver are tables of CELLS.
    """
    pieces = cut_lineage(sentences(df))
    every = _counts(pieces, lambda block: [0] * len(block), 1)[0].astype(np.float64)
    first = phrase_counts()
    tables = np.stack([_ratio(x, every) for x in first])
    for _ in range(ROUNDS):
        shared = df.sparkSession.sparkContext.broadcast(Model(tables, {}))

        def classes(block: list[str], shared=shared) -> list[int]:
            (owner, _, _, shares, _), _ = Scorer(shared.value).block(block, fields=False)
            of = np.full(len(block), -1)
            taught = shares.max(0) >= TEACH
            of[owner[taught]] = shares.argmax(0)[taught]
            return of.tolist()

        learnt = _counts(pieces, classes, len(WHOLE))
        natural = np.maximum(every - learnt.sum(0), 0)
        own = first.copy()
        for k in range(len(WHOLE)):
            if learnt[k].sum():
                own[k] = (first[k] / first[k].sum() + learnt[k] / learnt[k].sum()) * first[k].sum()
        tables = np.stack([_ratio(x, natural) for x in own])
    return Model(tables, fitted())


def save_model(spark: SparkSession, model: Model, path: str) -> None:
    """Writes what fit() gave, to judge later texts by it."""
    kinds, cells = np.indices(model.tables.shape)
    grams = spark.createDataFrame(pd.DataFrame({"kind": kinds.ravel().astype(np.int32), "cell": cells.ravel().astype(np.int32), "ratio": model.tables.ravel(), "feature": None}), "kind int, cell int, ratio double, feature string")
    weights = spark.createDataFrame([(-1, None, float(w), f) for f, w in model.fields.items()], grams.schema)
    grams.unionByName(weights).repartition(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> Model:
    """What save_model() wrote."""
    rows = spark.read.parquet(path).toPandas()
    grams, weights = rows[rows["kind"] >= 0], rows[rows["kind"] < 0]
    tables = np.zeros((grams["kind"].max() + 1, CELLS), np.float32)
    tables[grams["kind"], grams["cell"].astype(int)] = grams["ratio"]
    return Model(tables, dict(zip(weights["feature"], weights["ratio"])))


def residue(df: DataFrame, key: str, text: str, model: Model | None = None) -> DataFrame:
    """`key` with has_filler, is_notice, has_field and is_residue, one row for each row of `df`.

    `model` comes from fit(); without one it is fitted to `df` now. Null, empty and blank texts are no residue. Texts
    are scored whole. Repeated rows stay; extra columns are left out.
    """
    texts = spread(df.select(F.col(key).alias(key), F.col(text).alias("text")))
    shared = df.sparkSession.sparkContext.broadcast(model or fit(texts))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            parts = [scorer.judge(block) for block in _blocks(v.as_py() for v in batch.column(1))]
            columns = [pa.array(np.concatenate([p[k] for p in parts]) if parts else [], pa.bool_()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [key, "has_filler", "is_notice", "has_field"])

    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, has_filler boolean, is_notice boolean, has_field boolean"
    return texts.mapInArrow(judge, schema).withColumn("is_residue", F.col("has_filler") | F.col("is_notice") | F.col("has_field"))


def without_residue(df: DataFrame, key: str, text: str, model: Model | None = None) -> DataFrame:
    """The rows of `df`, all columns, that are no residue. Rows with a null key are judged by nothing and stay."""
    bad = residue(df, key, text, model).filter("is_residue").select(F.col(key).alias("residue_key")).distinct()
    return df.join(bad, df[key] == bad["residue_key"], "left_anti")
