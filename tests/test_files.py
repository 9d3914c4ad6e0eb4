"""Round trips of sources and sinks."""

import gzip
import hashlib
import json
import zipfile

import pytest

from corpusloom.functions import markup
from corpusloom.sources import files as S

ROWS = [("1", "zażółć, \"x\"\nline"), ("2", "")]


def pairs(df):
    return sorted((r["id"], r["text"]) for r in df.collect())


def rows(spark, data=ROWS):
    return spark.createDataFrame(data, "id string, text string")


def test_csv(spark, tmp_path):
    where = str(tmp_path / "t.csv")
    assert S.read_csv(spark, where, ["id", "text"]).count() == 0
    S.write_csv(rows(spark), where)
    assert pairs(S.read_csv(spark, where, ["id", "text"])) == sorted(ROWS)
    S.replace_csv(S.read_csv(spark, where, ["id", "text"]).where("id = '1'"), where)
    assert pairs(S.read_csv(spark, where, ["id", "text"])) == ROWS[:1]
    assert pairs(S.read_csv(spark, f"{where}.bak", ["id", "text"])) == sorted(ROWS)
    S.replace_csv(rows(spark, [("3", "c")]), where)
    assert pairs(S.read_csv(spark, where, ["id", "text"])) == [("3", "c")]
    both = S.read_csv_union(spark, [where, f"{where}.bak", str(tmp_path / "none")], ["id", "text"])
    assert sorted((r["id"], r["origin"]) for r in both.collect()) == [("1", f"{where}.bak"), ("3", where)]


def test_csv_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "b.csv").write_bytes("id,text\n7,ą\n".encode("utf-8-sig"))
    assert pairs(S.read_csv(spark, str(tmp_path / "b.csv"), ["id", "text"])) == [("7", "ą")]


@pytest.mark.parametrize("compress", [False, True])
def test_jsonl(spark, tmp_path, compress):
    where = tmp_path / "j"
    data = rows(spark, [("1", "ą"), ("2", None)]).coalesce(1)
    S.write_jsonl(data.select("text", "id"), str(where), compress)
    part = next(x for x in where.iterdir() if x.name.startswith("part"))
    raw = part.read_bytes()
    lines = (gzip.decompress(raw) if compress else raw).decode().splitlines()
    assert lines == ['{"id":"1","text":"ą"}', '{"id":"2","text":null}']
    assert sorted(S.read_jsonl(spark, str(where), data.schema).collect()) == sorted(data.collect())


def test_json_document(spark, tmp_path):
    S.write_json_document(spark, [{"text": "ą", "id": "1", "more": [1]}, {"id": "2", "text": "b"}], str(tmp_path / "d.json"))
    assert (tmp_path / "d.json").read_text().startswith('[\n  {\n    "id": "1",\n    "more"')
    assert pairs(S.read_json_document(spark, str(tmp_path / "d.json"), rows(spark).schema)) == [("1", "ą"), ("2", "b")]


def test_canonical_table(spark, tmp_path):
    names = S.CANONICAL.names
    good = spark.createDataFrame([tuple("3" for _ in names)], ", ".join(f"{n} string" for n in names))
    S.write_canonical(good.select(*reversed(names)), str(tmp_path / "c"))
    back = spark.read.parquet(str(tmp_path / "c"))
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in S.CANONICAL] and back.first()["token_count"] == 3
    with pytest.raises(ValueError):
        S.write_canonical(good.drop("license"), str(tmp_path / "d"))


def test_texts_and_checksums(spark, tmp_path):
    root = tmp_path / "r"
    (root / "sub" / "__pycache__").mkdir(parents=True)
    (root / "b.txt").write_bytes(b"ok \xff")
    (root / "sub" / "a.txt").write_text("ż")
    (root / "sub" / "__pycache__" / "c.txt").write_text("hidden")
    (root / "SUMS").write_text("hidden")
    wanted = spark.createDataFrame([("b.txt",), ("sub/a.txt",), ("none.txt",)], "name string")
    assert {r["name"]: r["text"] for r in S.texts_of(wanted, str(root), "name").collect()} == {"b.txt": "ok \ufffd", "sub/a.txt": "ż", "none.txt": ""}
    sums = S.read_checksums(spark, str(root), without=("SUMS",))
    expected = [("b.txt", 4, hashlib.sha256(b"ok \xff").hexdigest()), ("sub/a.txt", 2, hashlib.sha256("ż".encode()).hexdigest())]
    assert [tuple(r) for r in sums.collect()] == expected
    S.write_checksums(sums, str(tmp_path / "sums"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "sums")).collect()) == sorted(f"{h}  {p}" for p, _, h in expected)
    there = spark.createDataFrame([("b.txt", "0"), ("new", "1")], "path string, sha256 string")
    assert {tuple(r) for r in S.checksum_differences(sums, there).collect()} == {("b.txt", "changed"), ("sub/a.txt", "removed"), ("new", "added")}


def test_report(spark):
    report = S.markdown_table(spark.createDataFrame([("a|b", 1), (None, 2)], "k string, n int").orderBy("n"), "Counts")
    assert report == "# Counts\n\n| k | n |\n| --- | --- |\n| a\\|b | 1 |\n|  | 2 |\n"
    with pytest.raises(ValueError):
        S.markdown_table(spark.range(5), "Many", most=4)


def test_last_wins(spark):
    data = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("b", 2, "y")], "k string, n int, v string")
    assert {tuple(r) for r in S.last_wins(data, "k", "n").collect()} == {("a", 3, "z"), ("b", 2, "y")}


def docx(tmp_path):
    space = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    p = "<w:p><w:r><w:t>{}</w:t></w:r></w:p>".format
    cell = lambda x: f"<w:tc>{p(x)}</w:tc>"
    body = p("One") + f"<w:tbl><w:tr>{cell('a')}{cell('b')}</w:tr></w:tbl>" + p("Two")
    where = tmp_path / "x.docx"
    with zipfile.ZipFile(where, "w") as out:
        out.writestr("word/document.xml", f'<w:document xmlns:w="{space}"><w:body>{body}</w:body></w:document>')
    return where.read_bytes()


def test_documents_of_other_formats(spark, tmp_path):
    raw = docx(tmp_path)
    xml = b"<a><b>one</b><skip>no</skip><c>two</c>tail</a>"
    found = spark.createDataFrame([(raw, xml)], "d binary, x binary").select(markup.docx_text("d").alias("d"), markup.xml_text("x").alias("x")).first()
    assert found["d"] == "One\na | b\nTwo" and found["x"] == "one\nno\ntwo\ntail"
    broken = spark.createDataFrame([(b"no zip", b"<a>"), (None, None)], "d binary, x binary").select(markup.docx_text("d"), markup.xml_text("x"))
    assert [tuple(r) for r in broken.collect()] == [(None, None), (None, None)]
    assert markup.text_of_xml(xml, {"skip"}) == "one\ntwo\ntail"
    assert b"One" in markup.member_of_zip(raw, "document.xml") and markup.member_of_zip(raw, ".png") is None


def test_json_report_is_valid(spark, tmp_path):
    S.write_json_document(spark, {"b": 1, "a": "ł"}, str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text()) == {"a": "ł", "b": 1}


def test_files_with_any_byte_changed_do_not_fail_the_others(spark):
    """Every damage to an archive gives a text or an error."""
    import io

    held = io.BytesIO()
    space = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{space}"><w:body><w:p><w:r><w:t>{"Treść dokumentu. " * 20}</w:t></w:r></w:p></w:body></w:document>')
    raw = held.getvalue()
    for k in range(len(raw)):
        text, error = markup.readable(markup.text_of_docx, raw[:k] + bytes([raw[k] ^ 0xFF]) + raw[k + 1 :])
        assert (text is None) != (error is None), k
    deep = b"<a>" * 3000 + b"x" + b"</a>" * 3000
    found = spark.createDataFrame([(raw, deep), (raw[:50], b"<a>"), (None, None)], "d binary, x binary")
    rows = found.select(markup.docx_text("d").alias("d"), markup.xml_text("x").alias("x"), markup.reading(markup.text_of_docx)("d")["error"].alias("e")).collect()
    assert rows[0]["d"].startswith("Treść") and rows[0]["x"] == "x" and rows[0]["e"] is None
    assert rows[1]["d"] is None and rows[1]["x"] is None and "BadZipFile" in rows[1]["e"] and tuple(rows[2]) == (None, None, None)
    assert [r[0] for r in found.select(markup.zip_member("d", ".xml")["text"].startswith("<w:document")).collect()] == [True, None, None]
