"""The plan of curation: composed texts, decisions, and what is kept."""

import re
import unicodedata

from corpusloom.functions import unicode as U
from corpusloom.plans import curate


def test_settled_characters_stay_in_any_company(spark):
    settled = re.findall(f"[{U.SETTLED}]", "".join(map(chr, range(0x2100))))
    assert all(unicodedata.normalize("NFKC", c) == c and not unicodedata.combining(c) for c in settled) and len(settled) > 300
    text = "".join(settled)
    assert unicodedata.normalize("NFKC", text) == text and unicodedata.normalize("NFKC", text[::-1]) == text[::-1]
    texts = ["plain é", "ﬁ ①", "é", None, "ä b", "１２"]
    found = U.composed(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string"), "t").orderBy("k").collect()
    assert [r["t"] for r in found] == ["plain é", "fi 1", "é", None, "ä b", "12"]


def test_decisions_and_kept_rows(spark):
    long = "Ein langer Text über viele Dinge. " * 8
    rows = [(1, "a", "de", long), (2, "a", "de", long.replace("ü", "ü")), (3, "b", "de", "kurz"), (4, "b", "de", None), (5, "c", "de", "1234 " * 60), (6, "c", "de", long.upper()), (7, "c", "de", long + "Ende.")]
    decided = curate.decisions(spark.createDataFrame(rows, "doc_id bigint, source string, lang string, text string"))
    found = {r["doc_id"]: (r["reason"], r["duplicate_of"]) for r in decided.collect()}
    assert found == {1: (None, None), 2: ("duplicate", 1), 3: ("too_short", None), 4: ("too_short", None), 5: ("low_letter_ratio", None), 6: ("duplicate", 1), 7: (None, None)}
    kept = {r["text"]: r for r in curate.kept(decided).collect()}
    assert set(kept) == {long.strip(), long + "Ende."} and all(r["id"].startswith(r["source"] + "_") and r["token_count"] > 0 and r["created"] == "unknown" for r in kept.values())
