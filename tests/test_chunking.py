import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessella.operators import chunking, sections

SCHEMA = "artifact_id string, document_id string, pos int, artifact_type string, content string, is_heading boolean, heading_level int, source struct<source_file: string>"


def artifacts(spark, rows, document="d"):
    return spark.createDataFrame([(f"{document}{k}", document, k, "text", text, level is not None, level if level else None, ("f",)) for k, (text, level) in enumerate(rows)], SCHEMA)


def test_sections_start_at_high_headings_but_not_first(spark):
    df = artifacts(spark, [("T", 1), ("a", None), ("B", 2), ("b", None), ("C", 3), ("D", 0)])
    got = [(r["section_no"], r["section_title"]) for r in sections.with_sections(df).orderBy("pos").collect()]
    assert got == [(0, "Introduction"), (0, "Introduction"), (1, "B"), (1, "B"), (1, "B"), (2, "D")]


def test_heading_stack_pops_by_length(spark):
    df = artifacts(spark, [("one", 1), ("three", 3), ("again", 3), ("two", 2)])
    got = [list(r["path"]) for r in sections.heading_stack(df).orderBy("pos").collect()]
    assert got == [["one"], ["one", "three"], ["one", "three", "again"], ["one", "two"]]


def test_section_path_starts_with_the_title(spark):
    df = artifacts(spark, [("x", None), ("S", 1), ("y", None), ("sub", 3), ("deep", 3)])
    got = [list(r["heading_path"]) for r in sections.section_paths(sections.with_sections(df)).orderBy("pos").collect()]
    assert got == [["Introduction"], ["S"], ["S"], ["S", "sub"], ["S", "sub", "deep"]]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 120), min_size=1, max_size=40), st.integers(5, 40))
def test_packing(spark, sizes, budget):
    df = artifacts(spark, [("x" * n, None) for n in sizes])
    rows = chunking.pack(sections.with_sections(df), budget).orderBy("pos").collect()
    groups: dict[int, list[int]] = {}
    for r in rows:
        groups.setdefault(r["chunk_no"], []).append(r["n_tokens"])
    assert list(groups) == list(range(len(groups))) and [r["chunk_no"] for r in rows] == sorted(r["chunk_no"] for r in rows)
    assert all(sum(g) <= budget or len(g) == 1 for g in groups.values())
    for a, b in zip(list(groups.values()), list(groups.values())[1:]):
        assert sum(a) + b[0] > budget


def test_chunks_overlap_inside_a_section_only(spark):
    df = artifacts(spark, [("a" * 40, None), ("b" * 40, None), ("S", 1), ("c" * 40, None)])
    got = chunking.chunks(df, budget=10, overlap=2).orderBy("sequence_index").collect()
    assert [r["content"] for r in got] == ["a" * 40, "a" * 8 + "\n\n" + "b" * 40, "S", "S\n\n" + "c" * 40]
    assert [r["sequence_index"] for r in got] == [0, 1, 2, 3] and [r["artifact_ids"] for r in got][1] == ["d1"]
    assert got[1]["token_count"] == 12 and got[1]["n_artifact_tokens"] == 10
    assert got[0]["heading_path"] == ["Introduction"]


def test_path_of_a_chunk_has_the_heading_that_ended_it(spark):
    df = artifacts(spark, [("S", 1), ("x" * 40, None), ("sub", 3), ("y" * 40, None)])
    got = chunking.chunks(df, budget=10, overlap=0).orderBy("sequence_index").collect()
    assert [r["artifact_ids"] for r in got] == [["d0"], ["d1"], ["d2"], ["d3"]]
    assert [r["heading_path"] for r in got] == [["S"], ["S", "sub"], ["S", "sub"], ["S", "sub"]]


def test_markdown(spark):
    df = spark.createDataFrame([(1, "lead\n# A\ntext a\n\n##B\n  more\n# empty\n### C\nc"), (2, "no heading"), (3, None), (4, "")], "k long, t string")
    got = sorted(map(tuple, sections.markdown_sections(df, "k", "t").collect()))
    assert got == [(1, 1, "A", 1, "lead\ntext a"), (1, 2, "B", 2, "more"), (1, 4, "C", 3, "c")]


def test_fold_streams_long_groups(spark):
    rng = random.Random(1)
    rows = [(f"x{k}", "hot" if k % 3 else f"d{k % 50}", k, "text", "y" * rng.randrange(0, 80), False, None, None) for k in range(30_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["artifact_id"]: r["chunk_no"] for r in chunking.pack(sections.with_sections(df), 50).collect()}
    used, no, expected = None, 0, {}
    for a, d, _, _, text, *_ in rows:
        if d == "hot":
            n = max(1, len(text) // 4)
            if used is not None and used + n > 50:
                used, no = n, no + 1
            else:
                used = (used or 0) + n
            expected[a] = no
    assert all(got[a] == n for a, n in expected.items())


@pytest.mark.parametrize("rows", [[]])
def test_empty(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert chunking.chunks(df).collect() == []
