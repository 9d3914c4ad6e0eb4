"""Text and links from HTML, XML, DOCX and ZIP content."""

from __future__ import annotations

import io
import lzma
import struct
import zipfile
import zlib
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from corpusloom.functions.pages import PAGE, page_text

def text_of_html(markup: str) -> str:
    """The readable text of a whole page."""
    return page_text(markup, PAGE)[0]


def links_of_html(markup: str, base: str) -> list[str]:
    """Absolute links to the same host, without fragments, sorted and distinct."""

    class Links(HTMLParser):
        found: set[str] = set()

        def handle_starttag(self, tag, attrs):
            target = dict(attrs).get("href")
            if tag == "a" and target:
                whole = urlsplit(urljoin(base, target))
                if whole.netloc == urlsplit(base).netloc:
                    self.found.add(whole._replace(fragment="").geturl())

    reader = Links()
    reader.found = set()
    reader.feed(markup)
    return sorted(reader.found)


def text_of_xml(raw: bytes, excluded: set[str] = frozenset()) -> str:
    """Leaf texts in document order, one a line, without what stands below excluded tags."""
    out: list[str] = []
    waiting: list = [ElementTree.fromstring(raw)]  # elements to be read, and the texts behind those that were
    while waiting:
        node = waiting.pop()
        if isinstance(node, str):
            out.append(node)
            continue
        if isinstance(node.tag, str) and node.tag.rpartition("}")[2] in excluded:
            continue
        text = " ".join((node.text or "").split())
        if text and (not out or out[-1] != text):
            out.append(text)
        for child in reversed(node):
            if tail := " ".join((child.tail or "").split()):
                waiting.append(tail)
            waiting.append(child)
    return "\n".join(out)


def text_of_docx(raw: bytes) -> str:
    """Paragraphs, and table rows with cells joined by bars."""
    space = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(raw)).read("word/document.xml")).find(f"{space}body")

    def words(node):
        return "".join(x.text or "" for x in node.iter(f"{space}t")).strip()

    out = []
    for node in body:
        if node.tag == f"{space}p":
            out.append(words(node))
        elif node.tag == f"{space}tbl":
            out += [" | ".join(words(c) for c in row.iter(f"{space}tc")) for row in node.iter(f"{space}tr")]
    return "\n".join(x for x in out if x)


def member_of_zip(raw: bytes, suffix: str) -> bytes | None:
    """The first member whose name ends so."""
    archive = zipfile.ZipFile(io.BytesIO(raw))
    return next((archive.read(n) for n in sorted(archive.namelist()) if n.endswith(suffix)), None)


@F.pandas_udf(StringType())
def html_text(markup: pd.Series) -> pd.Series:
    return markup.map(text_of_html, na_action="ignore")


@F.pandas_udf(ArrayType(StringType()))
def html_links(markup: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([links_of_html(m, b) if m is not None and b is not None else [] for m, b in zip(markup, base)])


#: What the readers of broken files raise: damaged archives and members, unknown compression, passwords, missing parts, bad XML or encodings.
BROKEN = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, OSError, RuntimeError, NotImplementedError, LookupError, TypeError, ValueError, AttributeError, ElementTree.ParseError, OverflowError, struct.error)
READ = StructType([StructField("text", StringType()), StructField("error", StringType())])


def readable(read, raw: bytes) -> tuple[str | None, str | None]:
    """What ``read`` makes of a file and null, or null and what is wrong with a broken one, which doesn't fail the others."""
    try:
        return read(raw), None
    except BROKEN as error:
        return None, f"{type(error).__name__}: {error}"


def reading(read):
    """A pandas UDF: struct of text and error of a binary column; null gives nulls."""

    @F.pandas_udf(READ)
    def column(raw: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None, None) if x is None else readable(read, bytes(x)) for x in raw], columns=["text", "error"])

    return column


def docx_text(raw: Column | str) -> Column:
    return reading(text_of_docx)(raw)["text"]


def xml_text(raw: Column | str, excluded: frozenset[str] = frozenset()) -> Column:
    return reading(lambda x: text_of_xml(x, excluded))(raw)["text"]


def zip_member(raw: Column | str, suffix: str) -> Column:
    """Struct of the text (UTF-8, errors replaced) of the first member with that end of name, and the error of a broken archive."""
    return reading(lambda x: None if (found := member_of_zip(x, suffix)) is None else found.decode(errors="replace"))(raw)
