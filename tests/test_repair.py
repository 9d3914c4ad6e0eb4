"""Fixtures and brute force for mended texts, keys and contracts."""

import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import repair as R
from corpusloom.functions import text as X
from corpusloom.functions import unicode as U
from corpusloom.operators import contracts as C


def over(spark, values, build):
    data = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, t string")
    return [r["v"] for r in data.select("k", build(F.col("t")).alias("v")).orderBy("k").collect()]


def test_line_repair(spark):
    assert over(spark, ["a  \nb\n\n\n\n\nc", " \n", "", None], R.settled_newlines) == ["a\nb\n\n\nc\n", "", "", None]
    assert over(spark, ["a\n12\nb\n12345\n 7\n", "3"], R.without_page_numbers) == ["a\nb\n12345\n 7\n", ""]
    assert over(spark, ["sło-\nwo", "A-\nB", "a-\nb-\nc", "- -\nx"], R.unhyphenated) == ["słowo", "A-\nB", "abc", "- -\nx"]
    assert over(spark, ["one\ntwo", "one.\ntwo", "one\n\ntwo", "one\nTwo", "a\nb\nc"], R.unwrapped) == ["one two", "one.\ntwo", "one\n\ntwo", "one\nTwo", "a b c"]
    assert over(spark, ["Pra-\nca jest\nważna.\n17\nDalej"], R.repaired) == ["Praca jest ważna.\nDalej\n"]


def test_both_ends(spark):
    for n in range(9):
        items = [str(k) for k in range(n)]
        data = spark.createDataFrame([(items,)], "a array<string>").select(R.both_ends(F.col("a")).alias("v"))
        assert data.first()["v"] == items[:3] + items[-3:]


def test_paths(spark):
    paths = ["/a/b.tar.gz", "x", "/a/.hidden", "/a/", "c.txt", "a.b/c", "end."]
    assert over(spark, paths, R.path_suffix) == [".gz", "", "", "", ".txt", "", ""]
    assert over(spark, paths, R.path_stem) == ["b.tar", "x", ".hidden", "", "c", "c", "end."]


def test_classes_and_dates(spark):
    texts = ["Fundacja X i Izba", "IZBA lekarska", "Firma sp. z o.o.", "nic", "x" * 4000 + "fundacja"]
    assert over(spark, texts, lambda t: R.author_kind(F.lit("n"), t)) == ["ngo", "professional_body", "company", "unknown", "unknown"]
    raw = ["D:20240131120000", "D:19890101", "D:20241301", "D:20240132", "x", "", "D:29990101", "aD:20200229"]
    assert over(spark, raw, R.pdf_date) == ["2024-01-31", "unknown", "unknown", "unknown", "unknown", "unknown", "unknown", "2020-02-29"]
    assert over(spark, [r"\(a\)", r"\(a", r"\[\]\]", ""], R.unbalanced_math) == [False, True, True, False]


def test_canonical_hash(spark):
    values = ['{"b": [1, {"d": null, "c": "ą"}], "a": 1.5}', '{"a":1.5,"b":[1,{"c":"ą","d":null}]}', None]
    plain = hashlib.sha256(json.dumps(json.loads(values[0]), ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert over(spark, values, R.canonical_sha256) == [plain, plain, None]


def test_unicode_keys(spark):
    assert over(spark, ["ﬁ ①", None], U.nfkc) == ["fi 1", None]
    assert over(spark, ["Zażółć  gęślą, Jaźń!", "--"], U.slug) == ["zazoc-gesla-jazn", ""]
    assert over(spark, ["https://x.pl/%C5%BB%20A"], U.url_key) == ["https://x.pl/ż a"]
    assert over(spark, ["a &amp; b &lt;"], U.unescaped) == ["a & b <"]
    assert over(spark, ["Łódź: Études"], U.title_key) == ["łodz etudes"]
    assert over(spark, ["STRASSE  straße"], U.folded_key) == ["strasse strasse"]
    assert over(spark, ["A, b.  C!"], X.sentence_key) == ["a b c"]


def test_tags(spark):
    found = over(spark, ["a@b.pl", "ul. Polna 3, podpis", "44051401359", "none"], X.pii_tags)
    assert [set(filter(None, re.split(";", x))) for x in found] == [{"email"}, {"address", "signature_or_named_role"}, {"personal_identifier"}, set()]


def test_contracts(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id int, Email string")
    assert C.missing_columns(rows, ["x", "id", "y"]) == ["x", "y"]
    assert C.without_private(rows, ["email"]).columns == ["id"] and C.require_columns(rows, ["id"]) is rows and C.require(rows, {}) is rows
    C.require_public(rows, ["name"])
    C.require(rows, {"id": F.col("id") > 0})
    for breaks in (lambda: C.require_public(rows, ["email"]), lambda: C.require_columns(rows, ["x"]), lambda: C.require(rows, {"mail": F.col("Email") == "a"})):
        with pytest.raises(C.ContractError):
            breaks()


def test_strict_join(spark):
    left, right = spark.createDataFrame([(1,), (1,), (2,)], "id int"), spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    assert C.strict_join(left, right, "id").count() == 3
    for bad in (right.where("id = 1"), right.union(right)):
        with pytest.raises(C.ContractError):
            C.strict_join(left, bad, "id")


def test_registry_and_counters(spark):
    before = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], "k string, v int")
    after = spark.createDataFrame([("a", 2), ("b", None), ("d", None)], "k string, v int")
    assert {tuple(r) for r in C.registry_diff(before, after, "k").collect()} == {("a", "changed"), ("c", "removed"), ("d", "added")}
    maps = spark.createDataFrame([({"x": 1, "y": 2},), ({"x": 3},), (None,)], "m map<string,int>")
    assert {tuple(r) for r in C.counter_totals(maps, "m").collect()} == {("x", 4), ("y", 2)}


def test_lines_with_blanks_at_their_ends(spark):
    found = over(spark, ["koniec strony  \n 12 \ni dalej pra- \nca", "\t7 \n", "a \r\n b"], R.repaired)
    assert found == ["koniec strony i dalej praca\n", "", "a b\n"]


def test_phones_with_any_blank_are_tagged(spark):
    texts = ["tel 123\t456\n789", "123 456 789", "+48 123-456-789", "1234567890", "12 34", "a" * 9]
    plain = re.compile(r"(?<!\d)(?:\+?48[\s.-]?)?(?:\d[\s.-]?){9}(?!\d)")
    assert [x == "phone" for x in over(spark, texts, X.pii_tags)] == [bool(plain.search(x)) for x in texts] == [True, True, True, False, False, False]


def test_an_entry_that_gains_or_loses_a_field_changes(spark):
    before = spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], "k string, v int, old string")
    after = spark.createDataFrame([("a", 1, None), ("b", 2, "new")], "k string, v int, more string")
    assert {tuple(r) for r in C.registry_diff(before, after, "k").collect()} == {("a", "changed"), ("b", "changed")}
    same = spark.createDataFrame([("b", 2, None)], "k string, v int, more string")
    assert C.registry_diff(before.where("k = 'b'"), same, "k").count() == 0
