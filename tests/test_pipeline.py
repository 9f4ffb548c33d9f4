from pyspark.sql import functions as F

from tessella.operators import answers, enrich
from tessella.plans.pipeline import Options, Pipeline

SCHEMA = "artifact_id string, document_id string, pos int, artifact_type string, content string, is_heading boolean, heading_level int, source struct<source_file: string>"
CALLS = "/tmp/tessella-test-calls"


def counting():
    """A provider made here, so that workers get it by value: it fails for prompts with `broken` and notes each call."""
    path = CALLS

    class Counting(enrich.Extractive):
        def complete(self, prompt, model):
            with open(path, "a") as f:
                f.write("x\n")
            if "broken" in prompt:
                raise enrich.TimedOut
            return super().complete(prompt, model)

    return Counting


def calls():
    with open(CALLS) as f:
        return len(f.readlines())


def artifacts(spark, word):
    rows = []
    for d in ("d1", "d2"):
        for k, (text, level) in enumerate([("Suelo", 1), ("El suelo es rural. Se conserva. Fin.", None), ("Riesgo", 1), (f"El {word} riesgo es alto. Se vigila. Fin.", None)]):
            rows.append((f"{d}-{k}", d, k, "text", text, level is not None, level, (f"{d}.docx",)))
    return spark.createDataFrame(rows, SCHEMA)


def test_run_and_resume(spark, tmp_path):
    open(CALLS, "w").close()
    options = Options(provider=counting(), policy=enrich.Policy(tries=1, sleep=lambda s: None), slides=(8, 10))
    p = Pipeline(spark, str(tmp_path / "run"), options)
    first = p.run(artifacts(spark, "broken"), "summaries")
    assert sorted(r["status"] for r in first.collect()) == ["failed_timeout"] * 2 + ["success"] * 2 and calls() == 4
    p.run(artifacts(spark, "broken"), "summaries")
    assert calls() == 6  # only the failed ones again
    slides = p.run(artifacts(spark, "broken"))
    assert [r["slide_number"] for r in slides.orderBy("slide_number").collect()][:3] == [1, 2, 3]
    drafts = p.store.load("drafts")
    assert {r["heading"] for r in drafts.collect()} == {"Introduction"}
    assert p.store.load("reviews").count() >= 1 and p.gates().count() == 3
    done = calls()
    p.run(artifacts(spark, "broken"), "reviews")
    assert calls() <= done + 2  # drafts and reviews are there; failed summaries are tried again


def test_whole_run(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path / "run"), Options(slides=(8, 10)))
    p.run(artifacts(spark, "gran"))
    assert {r["heading"] for r in p.store.last_version("drafts").collect()} == {"Introduction", "Riesgo"}
    assert p.store.load("summaries").filter("status = 'success'").count() == 4
    assert p.store.load("reviews").groupBy("iteration").count().count() == 3  # confidence 0.5 asks for edits until the last round
    assert {r["version"] for r in p.store.load("drafts").select("version").distinct().collect()} == {1, 2, 3}


def test_answers(spark):
    one = lambda df: df.first()
    images = spark.createDataFrame([("a", "image", "", 0.1, 'x {"content_type": "Map", "description": "río", "data_summary": " "} y'), ("b", "image", "old", 0.3, "none")], "artifact_id string, artifact_type string, content string, confidence double, answer string")
    got = {r["artifact_id"]: r for r in answers.described(images).collect()}
    assert (got["a"]["artifact_type"], got["a"]["content"], got["a"]["confidence"], got["a"]["original_type"]) == ("map", "[MAP]\nrío", 0.5, "image")
    assert (got["b"]["artifact_type"], got["b"]["content"], got["b"]["confidence"]) == ("image", "old", 0.3)
    m = spark.createDataFrame([({"error": "e", "k": "v"}, "x" * 400), (None, "y")], "m map<string,string>, s string").select(answers.stamped(F.col("m"), {"status": F.col("s"), "error": F.lit(None)}).alias("m")).collect()
    assert m[0]["m"] == {"k": "v", "status": "x" * 300} and m[1]["m"] == {"status": "y"}
    assert one(answers.risk_text(spark.createDataFrame([], "level string, description string")))["text"] == "No risks were noted."
    assert one(answers.style_text(spark.createDataFrame([(2, "high", "tone", "b"), (1, "high", "tone", "a"), (3, "low", "x", "y")], "rule_id int, priority string, category string, rule string")))["text"] == "- tone: a\n- tone: b"
    raw = '{"parts": [{"type": "text", "text": "a"}, {"type": "tool"}, {"type": "text", "text": "b"}], "tokens": {"input": 3}}'
    e = one(spark.createDataFrame([(raw,)], "r string").select(answers.envelope(F.col("r")).alias("e")))["e"]
    assert (e["text"], e["tokens_in"], e["tokens_out"], e["error"]) == ("a\nb", 3, 0, None)
    df = spark.createDataFrame([(0.9,)], "c double")
    assert answers.checked(df, F.col("c") > 0.5, "low").count() == 1
    try:
        answers.checked(df, F.col("c") > 0.95, "too low").count()
        raise AssertionError
    except Exception as x:  # noqa: BLE001
        assert "too low" in str(x)
    assert one(spark.createDataFrame([("x" * 40,)], "t string").select(answers.fits(F.col("t"), F.lit(20), F.lit(10)).alias("f")))["f"] is True


def test_command_line(spark, tmp_path, capsys):
    from tessella.__main__ import main

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("# Uno\nPrimera frase. Segunda frase.\n# Dos\nOtra frase.")
    root = str(tmp_path / "run")
    assert main(["run", str(tmp_path / "in"), root, "--kind", "txt", "--until", "drafts", "--budget", "50", "--overlap", "5"]) == 0
    assert main(["status", root]) == 0
    out = capsys.readouterr().out.split("\n")
    assert out[0] == "artifacts 4" and out[1] == "chunks 2" and out[4] == "reviews -"
    assert main(["export", root, str(tmp_path / "x.tar.gz")]) == 0 and main(["import", str(tmp_path / "x.tar.gz"), str(tmp_path / "again")]) == 0
    assert main(["status", str(tmp_path / "again")]) == 0 and "chunks 2" in capsys.readouterr().out
    assert main(["clean", str(tmp_path / "again"), "--force"]) == 0 and main(["query", "no such", root]) == 2
