"""Media types by first bytes and address."""

from pyspark.sql import functions as F

from corpusloom.functions import classes


def test_media_types(spark):
    rows = [
        (b"%PDF-1.7", "text/html", "https://h/x.html", "application/pdf", ".pdf"), (b"PK\x03\x04..", "application/octet-stream", "https://h/a.DOCX?v=1.x", classes.OFFICE[".docx"], ".docx"),
        (b"PK\x03\x04", "", "https://h/a.odt", "application/zip", ".odt"), (b"PK\x03\x04", "application/x", None, "application/x", ".zip"), (b"PK\x05", None, "https://h.pl", "application/octet-stream", ".bin"),
        (b"<html>", "text/html", "https://h/dir.d/page.html#a.b", "text/html", ".html"), (None, "text/plain", "/a/b.verylongsuffix", "text/plain", ".bin"), (b"", "t/x", "https://h.pl/.hidden", "t/x", ".bin"),
    ]
    table = spark.createDataFrame([(k, *r[:3]) for k, r in enumerate(rows)], "k int, content binary, reported string, url string")
    found = table.select("k", classes.media_type(F.col("content"), F.col("reported"), F.col("url")).alias("m")).orderBy("k").collect()
    assert [tuple(r["m"]) for r in found] == [r[3:] for r in rows]
