"""Texts that were cut off (problem 3).

Evidence that a text lost its end, all of it from the corpus itself:

* a trie of the corpus vocabulary, by letters: the last word is unknown, or next to unknown, but a proper prefix of known
  words; and by words: its last words are a path that the corpus goes on from, of up to six words, but next to never ends
  at. By letters it sees cuts within words, by words those between them;
* lengths: texts of the same origin with open ends pile up at some lengths, in characters or in bytes;
* a mark of a cut, like `[...]`, a hyphen or a broken character, at the end.

The counts cover every text. What leaves a task is filtered by a bitmap, sized by the open ends, that says which nodes of
the trie any open end asks for, so that the shuffle follows the open ends and not the vocabulary; the bitmap only saves
work, as the join after it is exact.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.tables import cut_lineage, spread

#: Sizes of the groups of words before an end that are counted.
ORDERS = (1, 2, 3, 4, 6)
#: A group of words says how sentences go on if it was seen so often.
SEEN = 4
#: With an end at a limit, only sentences that nearly always end here are taken as whole; without, those that end at times.
ENDS_AT_LIMIT, ENDS_ELSEWHERE = 0.98, 0.03
#: Words from the end of a text that its last forms are read from: six, and names, which count as one form each.
WORDS = 48
#: A last word is unknown if it occurs less than once for so many occurrences of longer words: at any size some text holds it.
RARE = 1000
#: Open ends pile up at a length that half of its texts end openly at, and so many of them with different last words that
#: chance, at the rate of the lengths within AROUND, would make such a pile at any of the origin's lengths in CHANCE of cases.
CHANCE, AROUND = 1e-3, 25
#: Bits of the bitmap for each hash asked for, their bounds as powers of two (2^27 is 16 MB), and the most different
#: words that a task counts before it sends its counts on.
BITS_EACH, FEWEST_BITS, MOST_BITS, MOST = 16, 16, 27, 400_000

#: White space in Python, for what is cut off before a tail is taken.
_BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_UPPER = "A-ZÁÉÍÓÚÑÜÂÊÔÃÕÇÀÖÄ"
_NAME = re.compile(rf" (?<=[\w,;:%)»”] )[{_UPPER}]\w*(?: (?:de la |de los |del |de |da |do )?[{_UPPER}]\w*)*")
_TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|\n|[^\w\s]")
_WORD = re.compile(r"[^\W\d_]+")
_LAST_WORD = re.compile(r"[^\W\d_]+$")
_STOPS = {".", "!", "?", "…", "\n"}
_END = "\n"
#: Stands after a text whose open last form was taken off; neither a stop nor a form that any text has.
_BREAK = "<break>"
_MARK = re.compile(r"\s*(?:\[\s*(?:\.{2,}|…)\s*\]|\(\s*(?:\.{2,}|…)\s*\)|<\s*(?:\.{2,}|…)\s*>|�+)\s*$")
_DOTS = re.compile(r"\s*(?:\.{2,}|…)\s*$")
_HYPHEN = re.compile(r"(?<=[^\W\d_])[-‐‑]\s*$")
_CLOSED = re.compile(r"[.!?…][\"'»”’)\]*_]*\s*$|^[\W_]*$")
#: A full stop after a number or after one or two letters may be part of both.
_SHORT_STOP = re.compile(r"(?:\d|\s[^\W\d_]{1,2})\.$")
_ROW = re.compile(r"[-*•|]|\d+[.)]\s")
_OPEN = frozenset("abcdefghijklmnopqrstuvwxyzáéíóúñç0123456789%,;:|")


class _Forms(dict):
    """Tokens as they are counted: stops as one, numbers by their shape, words in lower case."""

    def __missing__(self, token: str) -> str:
        if len(self) > 200_000:
            self.clear()
        if token in _STOPS:
            form = _END
        elif token[0].isdigit():
            form = "9" * len(token) if len(token) <= 4 and token.isdigit() else "9.9"
        elif token in "*•–":
            form = "-"
        else:
            form = token.lower() if token != "N" else token
        self[token] = form
        return form


_FORMS = _Forms()


class _Hashes(dict):
    """64-bit hashes of forms."""

    def __missing__(self, form: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[form] = h = xxhash.xxh64_intdigest(form)
        return h


_HASHES = _Hashes()
#: Forms of numbers; inside a group they count as one.
_NUMBERS = ("9", "99", "999", "9999", "9.9")
_FACTOR, _ALL = 0x9E3779B97F4A7C15, (1 << 64) - 1


def group_hashes(tokens: list[str]) -> list[int]:
    """Hashes of the groups of forms at the end of a list, of the sizes in ORDERS: only the last form keeps a number's shape."""
    own = [_HASHES[t] for t in tokens]
    plain = [_HASHES["9"] if t[0] == "9" else h for t, h in zip(tokens, own)]
    out = []
    for n in ORDERS:
        if n <= len(own):
            acc = n
            for h in (*plain[len(own) - n : -1], own[-1]):
                acc = ((acc ^ h) * _FACTOR) & _ALL
                acc ^= acc >> 29
            out.append(acc - (1 << 64) if acc >> 63 else acc)
    return out


def all_group_hashes(own: np.ndarray, n: int) -> np.ndarray:
    """The hash of the group of n forms that ends at each place from n - 1 on, of the forms' own hashes."""
    plain = own.copy()
    plain[np.isin(own, np.array([_HASHES[x] for x in _NUMBERS], np.uint64))] = _HASHES["9"]
    acc = np.full(max(0, len(own) - n + 1), n, np.uint64)
    for k in range(n):
        acc ^= (own if k == n - 1 else plain)[k : len(own) - n + 1 + k]
        acc *= np.uint64(_FACTOR)
        acc ^= acc >> np.uint64(29)
    return acc.view(np.int64)


def forms(text: str, names: list[str] | None = None) -> list[str]:
    """The tokens of a text, with names as `N`, in the forms that are counted. `names`, if given, gets the names."""
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    if names is None:
        text = _NAME.sub(" N", text)
    else:
        text = _NAME.sub(lambda m: names.append(m.group()[1:]) or " N", text)
    return list(map(_FORMS.__getitem__, _TOKEN.findall(text)))


def _word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest("word " + word) - (1 << 63)


def read_end(tail: str, line: str = "") -> tuple[str, str | None, list[str], str]:
    """What the end of a text (its last WORDS words) is: a state, its last word, its last forms, and a place.

    `line` is how the last line begins, if it begins before the tail.

    States: `mark` (a mark that only cuts leave), `dots`, `open`, `stop` (a full stop that may belong to a number or an abbreviation), `closed`.
    Places: `row` (of a list or table), `name` (the last word is part of one), `text`.
    """
    state, tail, is_part = "open", tail.rstrip(), tail.count(" ") >= WORDS - 1
    last, token = tail[-1:], tail.rsplit(None, 1)[-1] if tail else ""
    if (last in "])>�" and _MARK.search(tail)) or (last in "-‐‑" and _HYPHEN.search(tail[-2:])):
        return "mark", None, [], "text"
    if last in ".…" and (m := _DOTS.search(tail)):
        state, tail = "dots", tail[: m.start()].rstrip()
    elif last == "." and _SHORT_STOP.search(tail[-4:]):
        state, tail = "stop", tail[:-1]
    elif last not in _OPEN and _CLOSED.search(token) and (_WORD.search(token) or _CLOSED.search(tail)):
        return "closed", None, [], "text"
    tokens = forms(tail[tail.find(" ") + 1 :] if is_part else tail)[-ORDERS[-1] :]
    last = _LAST_WORD.search(tail.rsplit(None, 1)[-1]) if tail else None
    line = tail[tail.rfind("\n") + 1 :].lstrip() if "\n" in tail else line.lstrip()
    place = "row" if _ROW.match(line) else "name" if tokens and tokens[-1] == "N" else "text"
    return state, last.group().lower() if last else None, tokens, place


def ends(records: DataFrame) -> DataFrame:
    """Each record once with what its end is: table_name, record_id, origin, n_chars, n_bytes, state, place, word, grams.

    `grams` holds hashes of the groups of forms at its end, `word` that of its last word. Null and blank texts, and
    records without an id, are left out.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states, words, grams, places = [], [], [], []
            for tail, line in zip(batch.column(5), batch.column(6)):
                state, word, tokens, place = read_end(tail.as_py(), line.as_py())
                states.append(state)
                words.append(None if word is None else _word_hash(word))
                grams.append(group_hashes(tokens))
                places.append(place)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(states, pa.string()), pa.array(places, pa.string()), pa.array(words, pa.int64()), pa.array(grams, pa.list_(pa.int64()))], ["table_name", "record_id", "origin", "n_chars", "n_bytes", "state", "place", "word", "grams"])

    # Blanks at the end are taken off here, however many, and the tail is whole words, however long.
    text = F.rtrim(F.replace("text", F.lit("\r"), F.lit("\n")), F.lit(_BLANKS))
    last_line = F.when(F.instr(text, "\n") > 0, F.ltrim(F.substring_index(text, "\n", -1), F.lit(_BLANKS))).otherwise("")
    # Of the last line only its beginning, a mark of a list or a number, is read.
    last_line = F.substring_index(last_line, " ", 2)
    rows = records.filter(F.col("record_id").isNotNull()).filter(text != "").select("table_name", F.col("record_id").cast("string").alias("record_id"), "origin", F.length("text").alias("n_chars"), F.octet_length("text").alias("n_bytes"), F.substring_index(text, " ", -WORDS).alias("tail"), last_line.alias("line"))
    out = spread(rows).mapInArrow(read, "table_name string, record_id string, origin string, n_chars int, n_bytes int, state string, place string, word long, grams array<long>")
    return out.groupBy("table_name", "record_id").agg(F.max(F.struct("n_chars", "n_bytes", "origin", "state", "place", "word", "grams")).alias("x")).select("table_name", "record_id", "x.*")


def _probes(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash."""
    h = h.view(np.uint64)
    return (h & np.uint64(bits - 1)).astype(np.int64), ((h >> np.uint64(33)) & np.uint64(bits - 1)).astype(np.int64)


def _bitmap(found: DataFrame) -> np.ndarray:
    """Packed bits of the hashes that open ends ask for: about BITS_EACH for each, between the bounds.

    Beyond 2^MOST_BITS / BITS_EACH open ends the bitmap lets more through and the join that follows has more to do.
    Blocks of bits are built by the workers; the driver gets them, at most 2^MOST_BITS bits.
    """
    asked = found.filter("state <> 'closed'").select(F.explode(F.concat("grams", F.filter(F.array("word"), lambda w: w.isNotNull()))).alias("h"))
    power = min(max(int(np.ceil(np.log2(asked.count() * BITS_EACH + 1))), FEWEST_BITS), MOST_BITS)
    bits, block = 1 << power, 1 << 16

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            for b in np.unique(at // block).tolist():
                held.setdefault(b, np.zeros(block, bool))[at[at // block == b] % block] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([np.packbits(x).tobytes() for x in held.values()], pa.binary())], ["block", "bits"])

    low, high = (F.expr(f"{h} & {bits - 1}L") for h in ("h", "shiftrightunsigned(h, 33)"))
    at = asked.select(F.explode(F.array(low, high)).alias("at"))
    rows = at.withColumn("block", F.expr(f"at div {block}")).repartition("block").select("at").mapInArrow(build, "block long, bits binary").collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        out[r["block"] * block // 8 : (r["block"] + 1) * block // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def _statistics(records: DataFrame, asked: np.ndarray) -> DataFrame:
    """h, seen, ended, known, longer, for hashes that are asked for: how often a word group was followed by something
    and by an end; how often a word occurs, and words that it is a proper prefix of. Last words of texts do not count."""
    shared = records.sparkSession.sparkContext.broadcast(asked)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally(np.unpackbits(shared.value).view(bool))
        for batch in batches:
            flat: list[str] = []
            for value in batch.column(0):
                tokens = tally.tokens(value.as_py())
                flat.extend(tokens)
                flat.extend((_END,) * ORDERS[-1])
                if len(flat) > 100_000:
                    tally.add(flat)
                    flat = []
                    if tally.size() > MOST:
                        yield tally.send()
            tally.add(flat)
        yield tally.send()

    texts = records.filter(F.col("text").isNotNull()).select("text")
    sums = spread(texts).mapInArrow(count, "h long, seen long, ended long, known long, longer long")
    return sums.groupBy("h").agg(*(F.sum(c).alias(c) for c in ("seen", "ended", "known", "longer")))


class _Tally:
    """Counts of one task: groups of forms that are asked for, by hash, and words."""

    def __init__(self, wanted: np.ndarray):
        self.wanted, self.bits = wanted, len(wanted)
        self.words: Counter = Counter()
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def tokens(self, text: str) -> list[str]:
        """The forms of a text, a break for an open last one, the words of its names counted."""
        names: list[str] = []
        tokens = forms(text, names)
        if tokens and tokens[-1] != _END:
            if tokens[-1] == "N" and names:
                names[-1] = names[-1].rpartition(" ")[0]
            tokens[-1] = _BREAK
        self.words.update(_WORD.findall(" ".join(names).lower()))
        return tokens

    def add(self, flat: list[str]) -> None:
        """Counts a run of forms."""
        self.words.update(flat)
        own = np.fromiter(map(_HASHES.__getitem__, flat), np.uint64, len(flat))
        before_end = np.append(own[1:] == np.uint64(_HASHES[_END]), False)
        for n in ORDERS:
            h = all_group_hashes(own, n)
            asked = self.asked(h)
            if len(asked):
                hashes, where = np.unique(h[asked], return_inverse=True)
                ended = np.bincount(where, before_end[n - 1 :][asked], len(hashes)).astype(np.int64)
                self.found.append((hashes, np.bincount(where, minlength=len(hashes)), ended))

    def asked(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that the bitmap lets through."""
        low, high = _probes(h, self.bits)
        at = np.flatnonzero(self.wanted[low])
        return at[self.wanted[high[at]]]

    def size(self) -> int:
        return max(len(self.words), sum(len(x[0]) for x in self.found) // 4)

    def send(self) -> pa.RecordBatch:
        """What was counted of hashes that are asked for; counts begin again."""
        rows: dict[int, list[int]] = {}
        for hashes, seen, ended in self.found:
            for h, a, b in zip(hashes.tolist(), seen.tolist(), ended.tolist()):
                row = rows.setdefault(h, [0, 0, 0, 0])
                row[0] += a
                row[1] += b
        trie: Counter = Counter()
        words = {w: n for w, n in self.words.items() if w.isalpha() and w != "N"}
        for word, n in words.items():
            for size in range(1, len(word)):
                trie[word[:size]] += n
        for column, counts in ((2, words), (3, trie)):
            names = list(counts)
            hashes = np.fromiter(map(_word_hash, names), np.int64, len(names))
            for at in self.asked(hashes).tolist():
                rows.setdefault(int(hashes[at]), [0, 0, 0, 0])[column] += counts[names[at]]
        self.words.clear()
        self.found.clear()
        numbers = np.array(list(rows.values()), np.int64).reshape(-1, 4)
        return pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int64()), *(pa.array(numbers[:, k]) for k in range(4))], ["h", "seen", "ended", "known", "longer"])


def cut_records(records: DataFrame) -> DataFrame:
    """Every record once with `is_cut`, and the evidence: state, at_limit, unknown_prefix, p_end.

    `records` has table_name, record_id, origin and text. Null and blank texts are not cut and have no row. A
    finished text is not cut whatever its length; a text that ends in a full stop is finished. Repeated records count
    once, by the longest of their texts.
    """
    found = cut_lineage(ends(records))
    stats = _statistics(records, _bitmap(found))
    asked = found.filter("state not in ('closed', 'mark')").select(
        "table_name", "record_id", F.posexplode(F.concat(F.array("word"), "grams")).alias("n", "h")
    ).filter("h is not null")
    judged = (
        asked.join(stats.hint("merge"), "h", "left")
        .groupBy("table_name", "record_id")
        .agg(
            F.max(F.when((F.col("n") > 0) & (F.col("seen") >= SEEN), F.struct(F.col("n"), (F.col("ended") / F.col("seen")).alias("p")))).alias("best"),
            F.max(F.when(F.col("n") == 0, F.coalesce(F.col("known"), F.lit(0)))).alias("known"),
            F.max(F.when(F.col("n") == 0, F.coalesce(F.col("longer"), F.lit(0)))).alias("longer"),
        )
        .select("table_name", "record_id", F.col("best.p").alias("p_end"), ((F.col("longer") > 0) & (F.col("known") * RARE < F.col("longer"))).alias("unknown_prefix"))
    )
    origin = F.coalesce(F.col("origin"), F.lit(""))
    within = lambda unit, back, firm=False: F.coalesce(F.exists(f"limits_{unit}", lambda x: F.col(f"n_{unit}").between(x["n"] - back, x["n"]) & (x["holds"] | F.lit(not firm))), F.lit(False))
    whole = (
        found.withColumn("origin_key", origin)
        .join(_limits(found), ["table_name", "origin_key"], "left")
        .join(judged, ["table_name", "record_id"], "left")
        .withColumn("at_limit", within("chars", 0) | within("bytes", 0) | (within("bytes", 3) & (F.coalesce("p_end", F.lit(0.0)) < ENDS_AT_LIMIT)))
        .withColumn("at_firm_limit", within("chars", 0, True) | within("bytes", 3, True))
        .withColumns({"p_known": F.col("p_end").isNotNull(), "p_end": F.coalesce("p_end", F.lit(0.0)), "unknown_prefix": F.coalesce("unknown_prefix", F.lit(False))})
    )
    broken = F.col("unknown_prefix") & ((F.col("p_end") < 0.5) | (F.col("place") == "name"))
    # At a limit that nearly all texts of the origin keep to, only a row may end without a stop.
    whole_here = ((F.col("place") == "row") | ~F.col("at_firm_limit")) & (F.col("p_end") >= ENDS_AT_LIMIT)
    is_cut = (
        F.when(F.col("state") == "closed", False)
        .when(F.col("state") == "mark", True)
        .when(F.col("state") == "stop", F.col("p_known") & (F.col("p_end") < 0.02))
        .when(F.col("state") == "dots", broken | (F.col("p_end") < F.when(F.col("at_limit"), 0.9).otherwise(0.05)))
        .when(F.col("at_limit"), broken | ~whole_here)
        .otherwise(broken | (F.col("p_end") < ENDS_ELSEWHERE))
    )
    return whole.select("table_name", "record_id", "origin", "state", "n_chars", "n_bytes", "at_limit", "unknown_prefix", "p_end", is_cut.alias("is_cut"))


def _limits(found: DataFrame) -> DataFrame:
    """By table and origin all lengths at which open ends pile up, in characters and in bytes: see CHANCE.

    A pile is held against the lengths around it, so it counts alike at every size of an origin and an origin may have
    several limits; `holds` says of each whether at most a fiftieth of the origin's texts are longer. Open ends with the same last words, like those of copies, count once.
    """
    lengths = F.array(*(F.struct(F.lit(unit).alias("unit"), F.col(f"n_{unit}").alias("n")) for unit in ("chars", "bytes")))
    rows = found.select("table_name", F.coalesce(F.col("origin"), F.lit("")).alias("origin_key"), F.explode(lengths).alias("x"), F.when(F.col("state") != "closed", F.xxhash64("grams", "word")).alias("end"))
    key = ["table_name", "origin_key", "unit"]
    ends = rows.select("table_name", "origin_key", "x.*", "end").groupBy(*key, "n", "end").agg(F.count("*").alias("texts"))
    by = ends.groupBy(*key, "n").agg(F.sum("texts").alias("texts"), F.count("end").alias("open"))
    near = Window.partitionBy(*key).orderBy("n").rangeBetween(-AROUND, AROUND)
    rate = F.greatest((F.sum("open").over(near) - F.col("open")) / (2 * AROUND), F.lit(0.5 / AROUND))
    k = F.col("open")
    # The logarithm of the chance of k by a Poisson law, k! by Stirling's formula, times the number of lengths.
    chance = k * F.ln("rate") - F.col("rate") - (k * F.ln(k) - k + F.ln(2 * math.pi * k) / 2) + F.ln(F.count("*").over(Window.partitionBy(*key)))
    beyond = F.sum("texts").over(Window.partitionBy(*key).orderBy("n").rowsBetween(1, Window.unboundedFollowing))
    holds = F.coalesce(beyond, F.lit(0)) * 50 <= F.sum("texts").over(Window.partitionBy(*key))
    piles = by.withColumns({"rate": rate, "holds": holds}).filter((k > F.col("rate")) & (k * 2 >= F.col("texts"))).withColumn("chance", chance).filter(F.col("chance") < math.log(CHANCE))
    return piles.groupBy("table_name", "origin_key").agg(*(F.collect_list(F.when(F.col("unit") == unit, F.struct("n", "holds"))).alias(f"limits_{unit}") for unit in ("chars", "bytes")))


def cut_rates(judged: DataFrame) -> DataFrame:
    """Number and share of cut records by table and origin."""
    return judged.groupBy("table_name", "origin").agg(F.count("*").alias("n_records"), F.count_if("is_cut").alias("n_cut"), (F.count_if("is_cut") / F.count("*")).alias("cut_share"))


def summary_records(summaries: DataFrame, sections: DataFrame) -> DataFrame:
    """Texts of chunk_summaries and draft_sections as records."""
    return summaries.select(F.lit("chunk_summaries").alias("table_name"), F.col("summary_id").alias("record_id"), "origin", F.col("summary").alias("text")).unionByName(
        sections.select(F.lit("draft_sections").alias("table_name"), F.col("section_id").alias("record_id"), "origin", F.col("content").alias("text"))
    )
