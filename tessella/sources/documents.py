"""Readers that turn files into artifacts: DOCX, HTML and plain text; PDF if a library is there."""

from __future__ import annotations

import hashlib
import io
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessella.functions.text import HEADING_STYLES

ARTIFACT = (
    "document_id string, source_file string, pos int, artifact_id string, artifact_type string, content string, is_heading boolean, heading_level int, "
    "heading_path array<string>, table_data array<map<string,string>>, image binary, image_format string, page int, error string"
)
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def scan(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Files of one folder by name pattern: path, length, modificationTime, content. Content is read only if it is used."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "false").load(folder)


def read_documents(files: DataFrame, parse) -> DataFrame:
    """Artifacts of files by `parse(name, bytes)`; a file that cannot be parsed gives one row with its error."""

    schema = StructType.fromDDL(ARTIFACT)
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                name, data = path.rsplit("/", 1)[-1], data.as_py()
                document = hashlib.sha256(name.encode() + b"\0" + data).hexdigest()[:32]
                try:
                    rows = list(parse(name, data))
                except Exception as x:  # noqa: BLE001 - one bad file must not stop the others
                    rows = [{"artifact_type": "error", "error": f"{type(x).__name__}: {x}"[:300]}]
                for k, r in enumerate(rows):
                    r.update(document_id=document, source_file=name, pos=k, artifact_id=f"{document}-{k:06d}")
                    if r.get("table_data"):
                        r["table_data"] = [list(cells.items()) for cells in r["table_data"]]
                yield pa.RecordBatch.from_pylist(rows, schema=target)

    return files.select("path", "content").mapInArrow(run, schema)


def document_totals(artifacts: DataFrame) -> DataFrame:
    """By document: text length, tables, images, headings, and the headings in order."""
    is_text = (F.col("artifact_type") == "text") & ~F.coalesce("is_heading", F.lit(False))
    return artifacts.groupBy("document_id", "source_file").agg(
        F.coalesce(F.sum(F.when(is_text | (F.col("artifact_type") == "table"), F.length("content"))), F.lit(0)).alias("total_text_length"),
        F.count_if(F.col("artifact_type") == "table").alias("total_tables"),
        F.count_if(F.col("artifact_type") == "image").alias("total_images"),
        F.array_sort(F.collect_list(F.when(F.col("is_heading"), F.struct("pos", F.col("heading_level").alias("level"), F.col("content").alias("text"), F.col("heading_path").alias("path"))))).alias("heading_structure"),
    )


def grid(rows: list[list[str]]) -> dict | None:
    """A table artifact of rows of cells; none for fewer than two rows."""
    if len(rows) < 2:
        return None
    head = [c.strip() for c in rows[0]]
    if not any(head):
        head = [f"col_{k}" for k in range(len(head))]
    lines = [" | ".join(head), " | ".join("-" * len(h) for h in head), *(" | ".join(r) for r in rows[1:])]
    return {"artifact_type": "table", "content": "\n".join(lines), "is_heading": False, "table_data": [dict(zip(head, r)) for r in rows[1:]]}


class Path:
    """The headings above a place: a heading takes the place of those at its depth and below."""

    def __init__(self) -> None:
        self.stack: list[str] = []

    def heading(self, text: str, level: int) -> list[str]:
        del self.stack[max(level, 1) - 1 :]
        self.stack.append(text)
        return list(self.stack)


def parse_docx(name: str, data: bytes) -> Iterator[dict]:
    """Paragraphs and tables in the order of the body, then images."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        styles = {}
        if "word/styles.xml" in z.namelist():
            for s in ElementTree.fromstring(z.read("word/styles.xml")).iter(f"{_W}style"):
                label = s.find(f"{_W}name")
                styles[s.get(f"{_W}styleId")] = label.get(f"{_W}val") if label is not None else ""
        above = Path()
        for element in _body(z):
            if element.tag == f"{_W}p":
                text = _text(element).strip()
                if not text:
                    continue
                style = element.find(f"{_W}pPr/{_W}pStyle")
                label = styles.get(style.get(f"{_W}val"), style.get(f"{_W}val") or "") if style is not None else ""
                row = {"artifact_type": "text", "content": text, "is_heading": label.startswith(HEADING_STYLES)}
                if row["is_heading"]:
                    row["heading_level"] = next((int(p) for p in label.split() if p.isdigit()), 1)
                    row["heading_path"] = above.heading(text, row["heading_level"])
                else:
                    row["heading_path"] = list(above.stack)
                yield row
            elif element.tag == f"{_W}tbl":
                cells = [[_text(c).strip() for c in r.findall(f"{_W}tc")] for r in element.findall(f"{_W}tr")]
                if table := grid(cells):
                    yield table | {"heading_path": list(above.stack)}
        for part in sorted(n for n in z.namelist() if n.startswith("word/media/")):
            kind = part.rsplit(".", 1)[-1].lower()
            yield {"artifact_type": "image", "content": "", "is_heading": False, "image": z.read(part), "image_format": "jpeg" if kind == "jpg" else kind, "heading_path": list(above.stack)}


def _body(z: zipfile.ZipFile) -> Iterator[ElementTree.Element]:
    """The elements of a document's body, one after the other; what was read is let go, so documents may be of any size."""
    with z.open("word/document.xml") as stream:
        depth, body = 0, None
        for event, element in ElementTree.iterparse(stream, ("start", "end")):
            if event == "start":
                depth += 1
                if depth == 2 and element.tag == f"{_W}body":
                    body = element
            else:
                depth -= 1
                if body is not None and depth == 2:
                    yield element
                    body.clear()


def _text(element) -> str:
    out = []
    for node in element.iter():
        if node.tag == f"{_W}t":
            out.append(node.text or "")
        elif node.tag in (f"{_W}br", f"{_W}cr"):
            out.append("\n")
        elif node.tag == f"{_W}tab":
            out.append("\t")
    return "".join(out)


class _Html(HTMLParser):
    BLOCKS = {"p", "li", "blockquote", "pre", "figcaption", "dd", "dt"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.above, self.text, self.kind, self.skip = Path(), [], "", 0
        self.table: list[list[str]] | None = None

    def flush(self) -> None:
        text = re.sub(r"\s+", " ", "".join(self.text)).strip()
        self.text = []
        if text and re.fullmatch("h[1-6]", self.kind):
            level = int(self.kind[1])
            self.rows.append({"artifact_type": "text", "content": text, "is_heading": True, "heading_level": level, "heading_path": self.above.heading(text, level)})
        elif text:
            self.rows.append({"artifact_type": "text", "content": text, "is_heading": False, "heading_path": list(self.above.stack)})
        self.kind = ""

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "noscript", "template"):
            self.skip += 1
        elif tag == "table":
            self.flush()
            self.table = []
        elif self.table is not None and tag == "tr":
            self.table.append([])
        elif self.table is not None and tag in ("td", "th"):
            if not self.table:
                self.table.append([])
            self.table[-1].append("")
        elif tag in self.BLOCKS or re.fullmatch("h[1-6]", tag):
            self.flush()
            self.kind = tag
        elif tag == "br":
            self.text.append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "noscript", "template"):
            self.skip = max(0, self.skip - 1)
        elif tag == "table" and self.table is not None:
            found = grid([[c.strip() for c in r] for r in self.table])
            self.table = None
            if found:
                self.rows.append(found | {"heading_path": list(self.above.stack)})
        elif tag in self.BLOCKS or re.fullmatch("h[1-6]", tag):
            self.flush()

    def handle_data(self, data):
        if self.skip:
            return
        if self.table is not None:
            if self.table and self.table[-1]:
                self.table[-1][-1] += data
        else:
            self.text.append(data)


def parse_html(name: str, data: bytes) -> Iterator[dict]:
    """Headings, blocks and tables in order; scripts and styles are left out."""
    parser = _Html()
    parser.feed(data.decode("utf-8", "replace"))
    parser.close()
    parser.flush()
    yield from parser.rows


def parse_text(name: str, data: bytes) -> Iterator[dict]:
    """Lines that are not blank; a line that begins with # is a heading of that depth."""
    above = Path()
    for line in re.split(r"\r\n|\r|\n", data.decode("utf-8", "replace")):
        if m := re.match(r"(#{1,6})\s+(.*\S)", line):
            yield {"artifact_type": "text", "content": m[2], "is_heading": True, "heading_level": len(m[1]), "heading_path": above.heading(m[2], len(m[1]))}
        elif line.strip():
            yield {"artifact_type": "text", "content": line.strip(), "is_heading": False, "heading_path": list(above.stack)}


def font_heading(size, bold):
    """Level of a block in a page by its largest font size and weight: 1 from 20 points, 2 from 16, 3 from 14 if bold, else null."""
    return F.when(size >= 20, 1).when(size >= 16, 2).when((size >= 14) & bold, 3)


def span_level(spans: list[dict]) -> int | None:
    """font_heading() of the spans of a block: the last one that makes it a heading counts."""
    level = None
    for s in spans:
        if s["size"] >= 16 or (s["size"] >= 14 and s["flags"] & 16):
            level = 1 if s["size"] >= 20 else 2 if s["size"] >= 16 else 3
    return level


def parse_pdf(name: str, data: bytes) -> Iterator[dict]:
    """Text blocks, tables and images of pages, by PyMuPDF, which is optional: without it the file gives one error row."""
    import fitz

    above = Path()
    with fitz.open(stream=data, filetype="pdf") as document:
        for number, page in enumerate(document, 1):
            for block in page.get_text("dict")["blocks"]:
                spans = [s for line in block.get("lines", ()) for s in line["spans"]]
                text = "\n".join("".join(s["text"] for s in line["spans"]) for line in block.get("lines", ())).strip()
                if not text:
                    continue
                level = span_level(spans)
                path = above.heading(text, level) if level else list(above.stack)
                yield {"artifact_type": "text", "content": text, "is_heading": bool(level), "heading_level": level, "heading_path": path, "page": number}
            for found in page.find_tables():
                if table := grid([[c or "" for c in r] for r in found.extract()]):
                    yield table | {"page": number, "heading_path": list(above.stack)}
            for image in page.get_images(full=True):
                raw = document.extract_image(image[0])
                if raw["width"] >= 50 and raw["height"] >= 50:
                    yield {"artifact_type": "image", "content": "", "is_heading": False, "image": raw["image"], "image_format": raw["ext"], "page": number, "heading_path": list(above.stack)}


PARSERS = {"docx": parse_docx, "html": parse_html, "txt": parse_text, "pdf": parse_pdf}


def read_folder(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """Artifacts of all files of a kind in a folder."""
    return read_documents(scan(spark, folder, f"*.{kind}"), PARSERS[kind])
