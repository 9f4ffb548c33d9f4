import random
import sys
import types

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.operators import chunking, parsing, relational, usage
from tessella.sources import documents


def said(spark, *answers):
    return spark.createDataFrame([(f"k{n}", a) for n, a in enumerate(answers)], "id string, answer string")


def test_summaries_have_defaults(spark):
    rows = parsing.summaries(said(spark, 'Of course: {"summary": "S", "key_facts": [{"fact": "f"}], "numeric_table": [{"label": "a"}]} bye', "no json", None, "{broken", '{"confidence": 0.9}')).orderBy("id").collect()
    assert rows[0]["summary"] == "S" and rows[0]["confidence"] == 0.5 and tuple(rows[0]["key_facts"][0]) == ("f", "other", []) and tuple(rows[0]["numeric_table"][0]) == ("a", 0.0, "", "")
    assert all(r["summary"] == "" and r["key_facts"] == [] and r["uncertainties"] == [] for r in rows[1:]) and rows[4]["confidence"] == 0.9


def test_styles_have_defaults(spark):
    a, b = parsing.styles(said(spark, '{"rules": [{"rule": "brief"}], "tone_description": "calm"}', "none")).orderBy("id").collect()
    assert tuple(a["rules"][0]) == ("other", "brief", [], [], "medium") and a["tone_description"] == "calm" and a["section_order"] == []
    assert b["rules"] == [] and b["citation_style"] == ""


def test_annotations_take_ids_and_known_verdicts(spark):
    sections = spark.createDataFrame([("k0", "s1", "Intro", 1), ("k0", "s2", "Intro", 2), ("k0", "s3", None, 3), ("k9", "s9", "Plan", 1)], "draft_id string, section_id string, heading string, pos int")
    answers = said(spark, '{"annotations": [{"section_heading": "Intro", "verdict": "reject", "fact_check_passed": false}, {"section_heading": "Plan", "verdict": "fine"}, {}]}', "none").withColumnRenamed("id", "draft_id")
    got = [tuple(r) for r in parsing.annotations(answers, sections).select("section_id", "verdict", "fact_check_passed", "tone_check_passed", "risk_level").orderBy("annotation_no").collect()]
    assert got == [("s2", "reject", False, True, "low"), ("Plan", "accept", True, True, "low"), ("", "accept", True, True, "low")]
    r, none = parsing.reviews(answers).orderBy("draft_id").collect()
    assert (r["total_accept"], r["total_edit"], r["total_reject"]) == (2, 0, 1) and none["total_accept"] == 0 and none["overall_confidence"] == 0.0 and none["risk_register"] == []


def test_slides_are_cut_and_numbered(spark):
    answer = '{"slides": [{"title": "A", "bullets": ["one two", "three", "x", "y", "z", "six more words"]}, {"slide_number": 40}]}'
    a, b = parsing.slides(said(spark, answer, "none"), "id", F.lit(3)).orderBy("slide_number").collect()
    assert (a["slide_number"], a["title"], len(a["bullets"]), a["word_count"], a["suggested_visual"]) == (3, "A", 5, 9, "none")
    assert (b["slide_number"], b["title"], b["bullets"]) == (40, "", [])


def test_packed_slides_deal_sentences_in_order(spark):
    rows = spark.createDataFrame([("s", "H", "Uno. Dos! Tres? Cuatro.\nCinco", 2), ("t", None, None, 1), ("u", "U", "Solo", 3)], "section_id string, heading string, content string, n_slides int")
    got = {(r["section_id"], r["n"]): (r["title"], r["bullets"]) for r in parsing.packed_slides(rows).collect()}
    assert got["s", 1] == ("H (1/2)", ["Uno.", "Dos!", "Tres?"]) and got["s", 2] == ("H (2/2)", ["Cuatro.", "Cinco"]) and got["t", 1] == ("", [])
    assert [got["u", n][1] for n in (1, 2, 3)] == [["Solo"], [], []]


def test_style_and_listings_of_empty_tables(spark):
    empty = spark.createDataFrame([], "draft_id string, section_id string, heading string, content string, pos int")
    assert parsing.learnt_style(empty).first()["section_order"] == [] and parsing.first_headings(empty).collect() == []
    some = spark.createDataFrame([("d", f"s{k}", f"h{k % 3}", "- a\nb", k) for k in range(15)], empty.schema)
    assert parsing.learnt_style(some).first()["section_order"] == ["h0", "h1", "h2"] and parsing.learnt_style(some).first()["bullet_share"] == 0.5
    assert parsing.first_headings(some).count() == 10


def test_style_falls_back_to_the_first_files(spark):
    files = spark.createDataFrame([("a.docx",), ("b.docx",), ("c.docx",)], "file_name string")
    assert sorted(map(tuple, parsing.data_and_style(files, files).collect())) == [("a.docx", "data"), ("a.docx", "style"), ("b.docx", "data"), ("b.docx", "style"), ("c.docx", "data")]
    assert sorted(map(tuple, parsing.data_and_style(files, files.limit(0)).select("side").distinct().collect())) == [("style",)]


def test_quantiles_are_exact(spark):
    rng = random.Random(2)
    rows = [("hot", float(rng.choice([1, 5, 5, 7, rng.random() * 100]))) for _ in range(3000)] + [("one", 4.0), ("two", 1.0), ("two", 2.0), (None, 3.0), ("none", None)]
    got = {r["g"]: r for r in relational.quantiles(spark.createDataFrame(rows, "g string, v double"), "g", "v", {"m": 0.5, "p": 0.9}).collect()}
    for g in ("hot", "one", "two", None):
        own = [v for k, v in rows if k == g and v is not None]
        assert got[g]["m"] == pytest.approx(np.quantile(own, 0.5)) and got[g]["p"] == pytest.approx(np.quantile(own, 0.9))
    assert "none" not in got


def test_models_switch_after_fails_in_a_row(spark):
    kinds = ["f", "f", "ok", "f", "x", "f", "f", "f", None]
    df = spark.createDataFrame([("a", n, k) for n, k in enumerate(kinds)], "k string, t int, kind string")
    got = [r["model_no"] for r in usage.model_switches(df, ["k"], ["t"], F.col("kind") == "f", F.col("kind") == "ok", 2).orderBy("t").collect()]
    assert got == [0, 1, 1, 1, 1, 2, 2, 3, 3]


def test_sizes_are_those_of_the_chunks(spark, data):
    from tessella.queries import views as V

    whole = chunking.chunks(V.artifacts(spark, data), 60, 10).select("document_id", "section_no", "chunk_no", "n_artifact_tokens", "token_count")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, chunking.chunk_sizes(V.artifact_sizes(spark, data), 60, 10).select(whole.columns).collect()))


def test_pdf_headings_by_size_and_weight(monkeypatch):
    """The reader over a stand-in of the optional library."""
    span = lambda text, size, flags=0: {"text": text, "size": size, "flags": flags}
    blocks = [{"lines": [{"spans": [s]}]} for s in (span("Uno", 21), span("negrita", 11, 16), span("catorce", 14), span("Dos", 14, 16), span("Tres", 16))]

    class Page:
        def get_text(self, kind):
            return {"blocks": blocks + [{"lines": []}]}

        def find_tables(self):
            return [types.SimpleNamespace(extract=lambda: [["a", "b"], ["1", None]]), types.SimpleNamespace(extract=lambda: [["a"]])]

        def get_images(self, full):
            return [(0,), (1,)]

    class Document(list):
        def __enter__(self):
            return self

        def __exit__(self, *_):
            return None

        def extract_image(self, xref):
            return {"width": 49 + xref, "height": 60, "image": b"i", "ext": "png"}

    monkeypatch.setitem(sys.modules, "fitz", types.SimpleNamespace(open=lambda stream, filetype: Document([Page()])))
    rows = list(documents.parse_pdf("x.pdf", b""))
    assert [(r["content"], r.get("heading_level")) for r in rows if r["artifact_type"] == "text"] == [("Uno", 1), ("negrita", None), ("catorce", None), ("Dos", 3), ("Tres", 2)]
    assert rows[1]["heading_path"] == ["Uno"] and [r["artifact_type"] for r in rows[5:]] == ["table", "image"]
