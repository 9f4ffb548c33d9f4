from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.llm import splitting as S


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abc .\n\r!é́", max_size=600), st.integers(1, 80), st.integers(0, 90))
def test_pieces_cover_the_text(text, most, overlap):
    parts = S.spans(text, most, overlap)
    assert all(b - a <= most for a, b, _ in parts)
    kept = min(overlap, most - 1)
    assert [a for a, _, _ in parts[1:]] == [b - kept for _, b, _ in parts[:-1]]
    whole = "".join(text[a if k == 0 else a + kept : b] for k, (a, b, _) in enumerate(parts))
    assert whole == text and (len(parts) > 1) == (len(text) > most)


def test_ends_at_sentences_and_topics():
    fish, road = "La pesca del muelle trae peces. " * 3, "La vía tiene asfalto nuevo. " * 3
    text = (fish + road).strip()
    a, b, kind = S.spans(text, len(fish) + 30, 10)[0]
    assert kind == "topic" and text[:b] == fish.strip()


def test_without_boundaries():
    assert [k for _, _, k in S.spans("x" * 25, 10, 2)] == ["hard", "hard", "end"]
    assert S.spans("palabra " * 5, 20, 3)[0][2] == "word"
    assert S.spans("", 5, 1) == [] and S.spans("abc", 5, 1) == [(0, 3, "end")]
    a, b, _ = S.spans("xxxxxxxxxéyyyyyyyyyyyyyy", 10, 0)[0]
    assert b == 9


def frame(spark, rows):
    schema = "artifact_id string, artifact_type string, t int, content string, source struct<source_file: string, heading_path: array<string>>"
    return spark.createDataFrame(rows, schema).withColumn("delivered_at", F.timestamp_seconds("t")).withColumn("n", F.lit("clash")).withColumn("piece", F.lit("clash"))


def test_last_delivery_counts(spark):
    src, long = ("f", ["h"]), "Una frase corta. " * 4
    rows = [
        ("new_long", "text", 1, "x", src), ("new_long", "text", 2, long, src), ("new_short", "text", 1, long, src), ("new_short", "text", 2, "x", src), ("null_now", "text", 1, long, src), ("null_now", "text", 2, None, src),
        ("other", "free", 1, long, src), ("none", None, 1, long, src), ("edge", "text", 1, "y" * 30, None), ("over", "text", None, "y" * 31, None), ("twice", "text", 1, long, src), ("twice", "text", 1, long, src), ("blank", "text", 1, "", src),
    ]
    limits = spark.createDataFrame([("text", 30, 5), ("text", 30, 5), ("image", None, 1)], "artifact_type string, max_chars int, overlap_chars int")
    got = S.split_oversized(frame(spark, rows), limits).collect()
    assert {r["artifact_id"] for r in got} == {"new_long", "over", "twice"}
    mine = sorted((r for r in got if r["artifact_id"] == "twice"), key=lambda r: r["piece"])
    assert [r["piece"] for r in mine] == list(range(1, len(mine) + 1)) and all(r["n_pieces"] == len(mine) for r in mine)
    assert mine[0]["content"] + "".join(r["content"][5:] for r in mine[1:]) == long
    assert mine[0]["heading_path"] == ["h"] and mine[0]["source_file"] == "f"


def test_empty_tables(spark):
    limits = spark.createDataFrame([], "artifact_type string, max_chars int, overlap_chars int")
    assert S.split_oversized(frame(spark, [("a", "text", 1, "x" * 99, None)]), limits).collect() == []
    assert S.split_oversized(frame(spark, []), limits).collect() == []


def test_very_long_text():
    text = ("La junta revisó el plan de la zona. " * 20 + "\n\n") * 300
    parts = S.spans(text, 1600, 160)
    assert len(parts) > 100 and all(k in ("topic", "end") for _, _, k in parts)
