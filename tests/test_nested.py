"""Leaves of JSON against a recursive walk; narrative chunks."""

import json
import random
import re

from corpusloom.functions import nested

FIELDS = ("title-proc", "description-proc", "description-lot")


def walk(value, path="$"):
    if isinstance(value, dict):
        for k, x in value.items():
            yield from walk(x, path + (f".{k}" if re.fullmatch(r"[A-Za-z_]\w*", k, re.A) else f'."{k}"'))
    elif isinstance(value, list):
        for k, x in enumerate(value):
            yield from walk(x, f"{path}[{k}]")
    else:
        yield path, value if value is None or isinstance(value, str) else json.dumps(value)


def made(rng, depth):
    kind = rng.randrange(6 if depth else 4)
    if kind == 4:
        return {rng.choice("abc-dé") + str(k): made(rng, depth - 1) for k in range(rng.randrange(4))}
    if kind == 5:
        return [made(rng, depth - 1) for _ in range(rng.randrange(4))]
    return (rng.choice(("", "text", "ż\n")), rng.randrange(-5, 10**12), rng.random() < 0.5, None)[kind]


def test_leaves(spark):
    rng = random.Random(8)
    values = [made(rng, 6) for _ in range(120)] + [{"a": {"b": [{"c": [[[1]]]}]}}, [], {}, "x", None]
    rows = [(k, json.dumps(v, ensure_ascii=False)) for k, v in enumerate(values)] + [(900, None), (901, "{broken"), (902, "")]
    done = nested.leaves(spark.createDataFrame(rows, "id int, doc string"), "id", "doc").withColumn("path", nested.path_text(nested.F.col("path")))
    assert sorted((r["id"], r["path"], str(r["value"])) for r in done.collect()) == sorted((k, p, str(x)) for k, v in enumerate(values) for p, x in walk(v))


def test_narratives(spark):
    records = [
        (1, {"buyer-name": {"pol": ["Gmina"]}, "description-proc": {"pol": "Polski opis zamówienia o długości wystarczającej.", "eng": "English description of some length."}, "description-lot": {"pol": ["Kontakt: test@example.pl, telefon +48 123 456 789."]}}),
        (2, {"description-lot": [{"pol": ["Drugi opis części zamówienia", "krótki"]}, "Trzeci opis, bez języka w ogóle", {"eng": ["Not this one, however long"]}], "title-proc": {"pol": {"pol": "POLSKI  tytuł ﬁrmy zamawiającej"}}, "description-proc": "polski tytuł firmy ZAMAWIAJĄCEJ"}),
        (3, {"other": {"pol": "Tego pola nikt nie czyta wcale"}}), (4, ["title-proc", "Nie jest to rekord, tylko lista"]),
    ]
    table = spark.createDataFrame([(k, json.dumps(v)) for k, v in records] + [(5, None)], "id int, doc string")
    found = {r["id"]: (r["chunks"], r["redactions"]) for r in nested.narratives(table, "id", "doc", FIELDS).collect()}
    assert found[1][0] == ["Polski opis zamówienia o długości wystarczającej.", "Kontakt: [PII], telefon [Telefon]."]
    assert found[1][1]["email"] == found[1][1]["phone"] == 1
    assert found[2][0] == ["POLSKI tytuł firmy zamawiającej", "Drugi opis części zamówienia", "Trzeci opis, bez języka w ogóle"]
    assert found[3][0] == found[4][0] == found[5][0] == []


FORMS = """<R><FORM LG="PL" CATEGORY="ORIGINAL"><CONTRACTING_BODY><OFFICIALNAME> Gmina  Testowa </OFFICIALNAME><P>Akapit zamawiającego, którego nikt nie czyta</P></CONTRACTING_BODY>
<OFFICIALNAME>Nie stąd</OFFICIALNAME><OBJECT><P>Dostawa <b>sprzętu</b> komputerowego</P><P>DOSTAWA sprzętu  komputerowego</P><P>krótki</P><P>Kontakt: a@b.pl, tel. 123 456 789</P></OBJECT></FORM>
<FORM LG="PL" CATEGORY="TRANSLATION"><P>Tłumaczenie, które się nie liczy wcale</P></FORM><FORM LG="EN" CATEGORY="ORIGINAL"><P>An English paragraph of some length</P></FORM></R>"""


def test_forms(spark):
    table = spark.createDataFrame([(1, FORMS), (2, "<R><P>Poza formularzem, więc nie czytany</P></R>"), (3, "<broken"), (4, None)], "id int, xml string")
    found = {r["id"]: (r["chunks"], r["authors"], r["error"] is not None) for r in nested.form_narratives(table, "id", "xml").collect()}
    assert found == {1: (["Dostawa sprzętu komputerowego", "Kontakt: [PII], [Telefon]"], ["Gmina Testowa"], False), 2: ([], [], False), 3: ([], [], True), 4: ([], [], False)}
