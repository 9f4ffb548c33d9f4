import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.operators import enrich, lineage, quality, relational, retrieval, state, synthesis, usage


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# Gates


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_subnormal=False).map(lambda x: round(x, 3)), max_size=25), st.lists(st.floats(-1e6, 1e6).map(lambda x: round(x, 3)), max_size=25), st.sampled_from([0.01, 0.05, 0.5]))
def test_band_join_is_the_nested_loop(spark, left, held, tolerance):
    held = held + [x * 1.0101 for x in left[:5]] + [0.0]
    a, b = spark.createDataFrame([(k, x) for k, x in enumerate(left)], "k long, value double"), spark.createDataFrame([(x,) for x in held], "value double")
    hit = {k for k, v in enumerate(left) if any((v == 0 and h == 0) or (v != 0 and abs(h - v) <= tolerance * abs(v)) for h in held)}
    assert {r["k"] for r in quality.band_semi(a, b, tolerance).collect()} == hit
    assert {r["k"] for r in quality.band_semi(a, b, tolerance, anti=True).collect()} == set(range(len(left))) - hit


def test_gates(spark):
    none = spark.createDataFrame([], "confidence double")
    assert rows(quality.confidence_gate(none, "g"))[0] == ("g", True, 1.0, 0, 0, 0)
    some = spark.createDataFrame([(0.9,), (0.8,), (None,)], "confidence double")
    assert rows(quality.confidence_gate(some, "g"))[0] == ("g", False, pytest.approx(1.7 / 3), 3, 1, 2)
    ann = spark.createDataFrame([("accept", 0.9)] * 9 + [("reject", 0.9)], "verdict string, confidence double")
    assert rows(quality.review_gate(ann, F.avg("confidence"), F.lit(0)))[0][:3] == ("review_quality", True, pytest.approx(0.9))
    assert rows(quality.review_gate(ann.limit(0), F.avg("confidence"), F.count_if(F.lit(True))))[0] == ("review_quality", True, 1.0, 0, 0, 0)
    slides = spark.createDataFrame([(["a"] * 6,)] + [(["a"],)] * 89, "bullets array<string>")
    assert rows(quality.slide_gate(slides))[0] == ("slide_quality", False, 0.5, 90, 89, 1)
    assert rows(quality.verdict_counts(spark.createDataFrame([("odd",), (None,), ("edit",)], "verdict string")))[0] == (2, 1, 0)
    text = spark.range(1).select(quality.first_items(F.array(*(F.lit(str(k)) for k in range(12)))).alias("x")).first()["x"]
    assert len(text) == 11 and text[-1] == "... and 2 more"


def test_numeric_gate(spark):
    n = spark.createDataFrame([(1, 10.0, "ha"), (2, 20_000.0, "x"), (3, 0.0, "x")], "entry_id long, value double, unit string")
    s = spark.createDataFrame([("s", "hay 10,2 ha y 0 casos")], "section_id string, content string")
    assert rows(quality.numeric_gate(n, s))[0] == ("numeric_reconciliation", True, pytest.approx(2 / 3), 3, 2, 1)
    assert [r["severity"] for r in quality.unmatched_numbers(n, s).collect()] == ["medium"]


# Lineage


def test_lineage(spark):
    se = spark.createDataFrame([("s1", "H", [" A", "b", None, "a"]), ("s2", "I", []), ("s3", None, None)], "section_id string, heading string, source_chunk_ids array<string>")
    su = spark.createDataFrame([("a", "m1", "p1", "f1", 0.5, 1), ("A ", "m2", "p2", "f2", 0.5, 2)], "chunk_id string, summary_id string, provenance_id string, source_file string, confidence double, t int").withColumn("summarized_at", F.timestamp_seconds("t"))
    assert rows(lineage.lineage_chain(se, su), "ref_no") == [("s1", 0, "a", "p2", "f2", True), ("s1", 1, "b", "missing:b", None, False), ("s1", 3, "a", "p2", "f2", True)]
    assert rows(lineage.reference_report(se, su))[0] == (3, 1, 2, 1, pytest.approx(1 / 3), False)
    assert rows(lineage.inverted_index(se), "chunk_id") == [("a", 2, 1, "s1"), ("b", 1, 1, "s1")]
    assert rows(lineage.section_report(se, lineage.lineage_chain(se, su)), "section_id")[1] == ("s2", "- **I**: 0 references, 0 unknown, files: none")


# Retrieval


def test_nearest_is_brute_force(spark):
    rng = random.Random(1)
    data = [(k, [round(rng.random(), 2) for _ in range(3)]) for k in range(200)] + [(500, None), (501, [1.0])]
    v = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(5)
    q = spark.createDataFrame([(k, e) for k, e in data[:20]], "query_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in retrieval.nearest(v, q, 4).collect()}
    for k, e in data[:20]:
        order = sorted((sum((x - y) ** 2 for x, y in zip(e, f)), j) for j, f in data[:200])
        assert [got[k, n] for n in range(1, 5)] == [j for _, j in order[:4]]
    assert retrieval.nearest(v, q.limit(0), 3).collect() == [] and retrieval.nearest(v.limit(0), q, 3).collect() == []


def test_embed_and_upsert(spark):
    df = spark.createDataFrame([(1, "uno dos"), (2, "dos uno"), (3, None), (4, "tres")], "k long, t string")
    e = {r["k"]: list(r["embedding"]) for r in retrieval.embed(df, "k", "t", 16).collect()}
    assert e[1] == e[2] != e[4] and e[3] == [0.0] * 16 and math.isclose(sum(x * x for x in e[4]), 1)
    old, new = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, v int, t string"), spark.createDataFrame([("a", 2, "z"), (None, 3, "n")], "k string, v int, t string")
    assert rows(retrieval.upsert(old, new, "k", "v"), "k") == [("a", 2, "z"), ("b", 1, "y")]


# Synthesis


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("abÁ ", max_size=6), max_size=12), st.lists(st.text("abÁ ", max_size=6), max_size=12))
def test_containing_pairs_is_the_nested_loop(spark, outer, inner):
    a, b = spark.createDataFrame([(x,) for x in outer], "a string"), spark.createDataFrame([(x,) for x in inner], "b string")
    assert sorted(map(tuple, synthesis.containing_pairs(a, b).collect())) == sorted({(x, y) for x in outer for y in inner if y and x and y in x})


def test_match_sections(spark):
    t = spark.createDataFrame([("Uso del suelo",), ("RIESGO",), ("Nada",), ("Riesgo alto",), (None,)], "target string").filter("target is not null")
    g = spark.createDataFrame([("Uso del suelo", 1), ("el riesgo alto", 2), ("riesgo", 3), ("", 4)], "section string, ord int")
    assert rows(synthesis.match_sections(t, g), "target") == [("Nada", None, "none"), ("RIESGO", "el riesgo alto", "contains"), ("Riesgo alto", "el riesgo alto", "contains"), ("Uso del suelo", "Uso del suelo", "exact")]


def test_allocation(spark):
    df = spark.createDataFrame([("d", f"s{k}", k, "H", "x " * n) for k, n in enumerate([0, 50, 50])] + [("e", "t1", 0, "H", ""), ("e", "t2", 1, "H", None)], "draft_id string, section_id string, pos int, heading string, content string")
    got = {r["section_id"]: r["n_slides"] for r in synthesis.allocate(df).collect()}
    assert got == {"s0": 1, "s1": 49, "s2": 49, "t1": 49, "t2": 49}  # 99 slides: scaled by 98 over 99, 48.505 is 49 again
    slides = synthesis.numbered_slides(synthesis.allocate(df)).filter("draft_id = 'e'").orderBy("slide_number").collect()
    assert [r["slide_number"] for r in slides] == list(range(1, 101)) and [r["heading"] for r in slides[:3]] == ["title", "contents", "H"]


def test_groups_and_texts(spark):
    su = spark.createDataFrame([("m1", "d1", 2, "", ["P"], 0.5), ("m2", "d2", 1, "T", [], None), ("m3", "d1", 1, None, None, 0.7), ("m4", "d0", 2, None, ["P"], 0.9)], "summary_id string, document_id string, sequence_index int, section_title string, heading_path array<string>, confidence double")
    assert rows(synthesis.section_groups(su), "section") == [("General", 1, 0.7, ["m3"]), ("P", 2, pytest.approx(0.7), ["m4", "m1"]), ("T", 1, 0.0, ["m2"])]
    se = spark.createDataFrame([("d", "b", 1, "B", 2, "t"), ("d", "a", 0, None, None, None)], "draft_id string, section_id string, pos int, heading string, level int, content string")
    assert synthesis.draft_text(se).first()["text"] == "# \n\n\n\n## B\n\nt"
    pre = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 1), ("b", 1, 11)], "g string, o int, n int")
    assert rows(synthesis.prefix_within(pre, ["g"], ["o"], F.col("n"), 10).select("g", "o"), "g", "o") == [("a", 1), ("a", 2)]


# Usage


def test_deltas_with_a_reset(spark):
    df = spark.createDataFrame([("r", k, v) for k, v in enumerate([10, 10, 25, 4, None, 6])], "role string, t int, n int")
    assert [r["d_n"] for r in usage.deltas(df, ["role"], ["t"], ["n"]).orderBy("t").collect()] == [10, 15, 4, 6]


def test_streak_ends_with_success_only(spark):
    kinds = ["limit", "timeout", "limit", "success", "limit"]
    df = spark.createDataFrame([("r", k, x) for k, x in enumerate(kinds)], "role string, t int, kind string")
    got = usage.streaks(df, ["role"], ["t"], F.col("kind") == "limit", F.col("kind") == "success").orderBy("t").collect()
    assert [r["streak"] for r in got] == [1, 1, 2, 0, 1]


# State


def test_state(spark):
    df = spark.createDataFrame([("failed_timeout",), ("success",), (None,), ("pending",)], "s string")
    assert rows(df.select(state.is_failed(F.col("s")), state.needs_processing(F.col("s")))) == [(True, True), (False, False), (False, True), (False, True)]
    todo, done = spark.createDataFrame([("a",), ("B",), (None,)], "k string"), spark.createDataFrame([(" b ",), (None,)], "k string")
    assert [r["k"] for r in state.pending(todo, done, "k").collect()] in (["a", None], [None, "a"])
    old = spark.createDataFrame([("a", 1, "x", {"q": "1"}), ("a", 2, "y", None), ("a", 2, "y", None), (None, 9, "z", None)], "k string, v int, t string, m map<string,string>")
    assert rows(state.latest(old, "k", "v")) == [("a", 2, "y", None)]


# Enrichment


class Flaky:
    def __init__(self, *plan):
        self.plan, self.calls = list(plan), 0

    def complete(self, prompt, model):
        self.calls += 1
        step = self.plan.pop(0) if self.plan else "ok"
        if isinstance(step, Exception):
            raise step
        return f"{step} by {model}"


def quick(**more):
    waits = []
    return enrich.Policy(sleep=waits.append, **more), waits


def test_retries_and_fallback():
    policy, waits = quick(models=["m1", "m2"], tries=2)
    assert enrich.answer(Flaky(enrich.RateLimited(5), enrich.TimedOut(), "ok"), "p", policy) == ("ok by m2", "success", "m2", 3, None) and waits == [5]
    got = enrich.answer(Flaky(*[enrich.TimedOut()] * 9), "p", policy)
    assert got[1] == "failed_model_exhausted" and got[3] == 4
    assert enrich.answer(Flaky(enrich.BadAnswer("no json")), "p", policy)[1:4] == ("failed_other", "m1", 1)
    assert enrich.answer(Flaky(enrich.RateLimited()), "", policy)[1] == "failed_other"
    one, _ = quick(tries=1)
    assert enrich.answer(Flaky(enrich.RateLimited()), "p", one)[1] == "failed_rate_limit"


def test_enrich(spark):
    df = spark.createDataFrame([("a", "head\n\nUno. Dos. Tres."), ("b", None)], "k string, prompt string")
    got = rows(enrich.fallback(enrich.enrich(df, "k", "prompt")).select("k", "summary", "confidence"), "k")
    assert got == [("a", "Uno. Dos.", 0.5), ("b", "[failed: failed_other]", 0.0)]
    answers = spark.createDataFrame([('so: {"n": 3} ok',), ("none",)], "answer string")
    assert [r["n"] for r in enrich.parsed_answer(answers, "n int", {"n": 7}).collect()] == [3, 7]


# Relations


def test_asof_and_interval(spark):
    left = spark.createDataFrame([("a", 1, "x"), ("a", 5, "y"), ("b", 5, "z"), ("a", None, "w")], "k string, t int, v string")
    right = spark.createDataFrame([("a", 1, 10), ("a", 4, 40), ("a", 9, 90), ("a", None, 1)], "k string, t int, p int")
    assert rows(relational.asof_join(left, right, ["k"], "t", ["p"]).select("v", "asof_p"), "v") == [("w", None), ("x", 10), ("y", 40), ("z", None)]
    stamp = lambda df, *c: df.withColumns({x: F.timestamp_seconds(x) for x in c})
    p = stamp(spark.createDataFrame([("a", 0), ("a", 99), ("a", 100), ("b", 5)], "k string, t int"), "t")
    s = stamp(spark.createDataFrame([("a", 0, 100, "s1"), ("a", 90, 400, "s2"), ("a", 7, 7, "s3")], "k string, b int, e int, s string"), "b", "e")
    got = relational.interval_join(p, s, ["k"], "t", "b", "e", 60).select(F.unix_timestamp("t").alias("t"), "s")
    assert rows(got, "t", "s") == [(0, "s1"), (99, "s1"), (99, "s2"), (100, "s2")]


def test_review_queue_unites_three_sources(spark):
    from tessella.operators import quality

    summaries = spark.createDataFrame([("s1", 0.5), ("s2", 0.9)], "summary_id string, confidence double")
    annotations = spark.createDataFrame([("a1", "reject", "low"), ("a2", "accept", "low")], "section_id string, verdict string, risk_level string")
    risks = spark.createDataFrame([("high", "no source", ["a2", "a3"]), ("high", None, None), ("low", "x", ["a1"]), (None, "y", [])], "level string, description string, affected_sections array<string>")
    got = sorted(map(tuple, quality.review_queue(summaries, annotations, 0.85, risks).collect()))
    assert got == [("high_risk_annotation", "a1", "reject low"), ("high_risk_register_entry", "", ""), ("high_risk_register_entry", "a2, a3", "no source"), ("low_confidence_summary", "s1", "confidence 0.500")]
    assert quality.review_queue(summaries, annotations, 0.85).count() == 2
