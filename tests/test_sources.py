import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from tessella.sources import archive, documents, store


def docx(paragraphs, media=()):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = "".join(paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body>{body}</w:body></w:document>")
        z.writestr("word/styles.xml", f'<w:styles {w}><w:style w:styleId="H1"><w:name w:val="Heading 1"/></w:style><w:style w:styleId="H2"><w:name w:val="Título 2"/></w:style></w:styles>')
        for name, raw in media:
            z.writestr(f"word/media/{name}", raw)
    return out.getvalue()


def p(text, style=None):
    return f"<w:p>{f'<w:pPr><w:pStyle w:val={chr(34)}{style}{chr(34)}/></w:pPr>' if style else ''}<w:r><w:t>{text}</w:t></w:r></w:p>"


def tbl(*rows):
    return "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc>{p(c)}</w:tc>" for c in r) + "</w:tr>" for r in rows) + "</w:tbl>"


def test_docx_in_order(spark, tmp_path):
    (tmp_path / "b.docx").write_bytes(docx([p("Uno", "H1"), p("texto"), tbl(["a", "b"], ["1", "2"]), p(""), p("Dos", "H2"), p("fin")], [("i.png", b"\x89PNG")]))
    (tmp_path / "broken.docx").write_bytes(b"no zip")
    (tmp_path / "other.txt").write_text("x")
    got = documents.read_folder(spark, str(tmp_path), "docx").orderBy("source_file", "pos").collect()
    mine = [r for r in got if r["source_file"] == "b.docx"]
    assert [(r["artifact_type"], r["content"], r["heading_level"]) for r in mine] == [("text", "Uno", 1), ("text", "texto", None), ("table", "a | b\n- | -\n1 | 2", None), ("text", "Dos", 2), ("text", "fin", None), ("image", "", None)]
    assert mine[4]["heading_path"] == ["Uno", "Dos"] and mine[2]["table_data"] == [{"a": "1", "b": "2"}] and bytes(mine[5]["image"]) == b"\x89PNG"
    assert [r["artifact_type"] for r in got if r["source_file"] == "broken.docx"] == ["error"] and len({r["artifact_id"] for r in got}) == len(got)
    total = documents.document_totals(documents.read_folder(spark, str(tmp_path), "docx")).filter("source_file = 'b.docx'").first()
    assert (total["total_text_length"], total["total_tables"], total["total_images"]) == (5 + 3 + 17, 1, 1) and [h["text"] for h in total["heading_structure"]] == ["Uno", "Dos"]


def test_html_and_text(spark, tmp_path):
    (tmp_path / "a.html").write_text("<h1>T</h1><p>uno <b>dos</b></p><script>x</script><table><tr><th>k</th></tr><tr><td>v</td></tr></table><h3>S</h3><li>z &amp; y")
    got = documents.read_folder(spark, str(tmp_path), "html").orderBy("pos").collect()
    assert [(r["artifact_type"], r["content"]) for r in got] == [("text", "T"), ("text", "uno dos"), ("table", "k\n-\nv"), ("text", "S"), ("text", "z & y")] and got[4]["heading_path"] == ["T", "S"]
    (tmp_path / "a.txt").write_text("# T\r\n\r\nuno\n## S\ndos")
    assert [r["content"] for r in documents.read_folder(spark, str(tmp_path), "txt").orderBy("pos").collect()] == ["T", "uno", "S", "dos"]


def test_grid():
    assert documents.grid([["a"]]) is None
    assert documents.grid([["", ""], ["1", "2"]])["table_data"] == [{"col_0": "1", "col_1": "2"}]


def test_store(spark, tmp_path):
    s = store.Store(spark, str(tmp_path))
    assert not s.exists("t") and s.load("t", "a int").collect() == []
    with pytest.raises(FileNotFoundError):
        s.load("t")
    df = spark.createDataFrame([("a", 1, 10), ("b", 1, 20), ("c", 3, 30)], "k string, version int, n int")
    s.save("t", df, partition_by=["version"])
    assert s.version("t", 3).count() == 1 and s.first_version("t").count() == 2 and [r["k"] for r in s.last_version("t").collect()] == ["c"]
    s.save("t", df.filter("version = 3").withColumn("n", F.lit(99)), partition_by=["version"])
    assert s.load("t").count() == 3 and s.where("t", k="c").first()["n"] == 99
    s.save("u", df.select("k", "version", "n"))
    s.upsert("u", spark.createDataFrame([("a", 2, 11), ("b", 0, 0)], "k string, version int, n int"), "k", "version")
    assert sorted(map(tuple, s.load("u").select("k", "version", "n").collect())) == [("a", 2, 11), ("b", 1, 20), ("c", 3, 30)] and not s.exists("u.next")
    s.append("log", df.limit(1))
    s.append("log", df.limit(1))
    assert s.log("log", df.schema).count() == 2
    s.save_text("note", spark.createDataFrame([(2, "REVIEWED: yes"), (1, "# T")], "o int, t string"), "o", "t")
    assert s.load_text("note").first()["value"] == "# T\nREVIEWED: yes\n"
    s.drop("note")
    assert s.load_text("note").collect() == []


def test_read_objects(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"k": "a", "n": 1}, indent=1))
    (tmp_path / "b.json").write_text("{broken")
    schema = spark.createDataFrame([], "k string, n int").schema
    assert [(r["k"], r["file_name"]) for r in store.read_objects(spark, str(tmp_path), schema).collect()] == [("a", "a.json")]
    assert [r["file_name"] for r in store.read_objects(spark, str(tmp_path), schema, bad=True).collect()] == ["b.json"]


def test_archive(spark, tmp_path):
    run, out = tmp_path / "run", str(tmp_path / "r.tar.gz")
    for name in ("state.json", "chunks/a.json", "images/big.png", "notes.txt"):
        (run / name).parent.mkdir(parents=True, exist_ok=True)
        (run / name).write_text(name)
    files = archive.listing(spark, str(run))
    assert {r["path"] for r in archive.chosen(files, ["state.json", "chunks/", "*.txt"]).collect()} == {"state.json", "chunks/a.json", "notes.txt"}
    m = archive.manifest(archive.chosen(files, ["chunks/"])).first()
    assert (m["n_files"], m["total_size"]) == (1, len("chunks/a.json"))
    told = archive.export_run(str(run), out, "abcdef123456", ["state.json", "chunks/"])
    assert told["n_files"] == 2 and archive.read_manifest(out) == told and archive.archive_name("abcdef123456", "20240101") == "run_20240101_abcdef12.tar.gz"
    target = tmp_path / "in"
    assert sorted(archive.import_run(out, str(target), ["state.json", "chunks/"])) == ["chunks/a.json", "state.json"]
    with pytest.raises(FileExistsError):
        archive.import_run(out, str(target), ["state.json", "chunks/"])
    with pytest.raises(ValueError):
        archive.import_run(out, str(tmp_path / "in2"), ["state.json"])
    assert archive.clean_run(str(target), ["state.json"]) == ["chunks"] and archive.has_output(str(target))
    archive.clean_run(str(target), force=True)
    assert not archive.has_output(str(target))


def test_archive_refuses_paths_outside(tmp_path):
    bad = str(tmp_path / "bad.tar.gz")
    with tarfile.open(bad, "w:gz") as t:
        for name, raw in (("manifest.json", b"{}"), ("../x", b"1")):
            i = tarfile.TarInfo(name)
            i.size = len(raw)
            t.addfile(i, io.BytesIO(raw))
    with pytest.raises(ValueError):
        archive.import_run(bad, str(tmp_path / "t"), [""])
