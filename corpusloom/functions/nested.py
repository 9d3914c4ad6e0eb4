"""JSON of any depth as rows of leaves, and the narrative parts of multilingual records."""

from __future__ import annotations

from collections.abc import Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from corpusloom.functions import text as X
from corpusloom.functions import unicode as U
from corpusloom.operators.near import materialised

#: Fixed value: least code points of a chunk.
LEAST = 20
_STEP = "array<struct<pos: int, key: string>>"


def leaves(rows: DataFrame, key: str, json: str) -> DataFrame:
    """key, path (of pos and key; key is null in arrays), value (text; null for JSON's null) of every leaf.

    One pass a level, however deep the values are nested: what is an object or array is exploded, the
    rest is found. ``pos`` is the place in an array, and that of a key among an object's sorted keys. Empty
    objects and arrays, null and what isn't JSON have no leaves; of a key that repeats in an object
    the parser refuses the value, which has none then.
    """
    if key in ("v", "path", "pos", "key", "value"):
        raise ValueError(f"the key's column can't be named {key}")
    level = materialised(rows.select(key, F.try_parse_json(json).alias("v"), F.array().cast(_STEP).alias("path")).where("v is not null"))
    found = None
    while True:
        nested = F.schema_of_variant("v").rlike("^(OBJECT|ARRAY)")
        here = level.where(~nested).select(key, "path", F.expr("try_variant_get(v, '$', 'string')").alias("value"))
        found = here if found is None else found.unionByName(here)
        deeper = level.where(nested)
        if deeper.isEmpty():
            return found
        exploded = deeper.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("v").outer()))
        level = materialised(exploded.select(key, F.col("value").alias("v"), F.concat("path", F.array(F.struct("pos", "key")).cast(_STEP)).alias("path")))


def path_text(path: Column) -> Column:
    """A path as $.key[0].key; keys other than words are quoted."""
    step = lambda x: F.when(x["key"].isNull(), F.concat(F.lit("["), x["pos"].cast("string"), F.lit("]"))).when(
        x["key"].rlike("^[A-Za-z_][A-Za-z0-9_]*$"), F.concat(F.lit("."), x["key"])
    ).otherwise(F.concat(F.lit('."'), x["key"], F.lit('"')))
    return F.concat(F.lit("$"), F.array_join(F.transform(path, step), ""))


def narratives(records: DataFrame, key: str, json: str, fields: Sequence[str], language: str = "pol") -> DataFrame:
    """key, chunks, redactions (map) of each record: the texts of ``fields`` in one language, in their order, each once.

    Below a field, objects are looked into under ``language`` only and arrays entry by entry. Texts
    are composed, cleaned and masked; those of LEAST code points count, the first of those that are
    equal without case. Records without any have empty chunks; redactions count in all texts.
    """
    place = F.array_position(F.array(*map(F.lit, fields)), F.get("path", F.lit(0))["key"])
    below = F.slice("path", 2, F.greatest(F.size("path") - 1, F.lit(0)))
    own = leaves(records, key, json).where((F.size("path") > 0) & F.get("path", F.lit(0))["key"].isNotNull() & F.col("value").isNotNull() & (place > 0))
    own = own.where(F.forall(below, lambda x: x["key"].isNull() | (x["key"] == language)))
    order = F.struct(place.alias("field"), F.transform("path", lambda x: x["pos"]).alias("at"))
    return chunks_of(records, own.select(key, order.alias("order"), "value"), key)


def chunks_of(records: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """key, chunks, redactions of each record, from its ``texts`` (key, order, value)."""
    plain = materialised(texts.select(key, "order", X.cleaned_lines(U.nfkc("value")).alias("plain")).where("plain <> ''"))
    counts = X.redaction_counts(F.col("plain"))
    texts = plain.select(key, "order", X.redacted(F.col("plain")).alias("text"), *(c.alias(f"n_{k}") for k, c in counts.items()))
    keyed = texts.withColumn("same", U.folded_key("text"))
    firsts = keyed.where(F.length("text") >= LEAST).groupBy(key, "same").agg(F.min(F.struct("order", "text")).alias("first"))
    chunks = firsts.groupBy(key).agg(F.transform(F.sort_array(F.collect_list("first")), lambda x: x["text"]).alias("chunks"))
    redactions = keyed.groupBy(key).agg(F.create_map(*(x for k in counts for x in (F.lit(k), F.sum(f"n_{k}")))).alias("redactions"))
    whole = records.select(key).distinct().join(chunks, key, "left").join(redactions, key, "left")
    return whole.select(key, F.coalesce("chunks", F.array().cast("array<string>")).alias("chunks"), "redactions")


def form_narratives(records: DataFrame, key: str, xml: str, language: str = "PL") -> DataFrame:
    """key, chunks, redactions, authors, error of records whose XML holds forms in several languages: as ``narratives``,
    from the paragraphs of the original form in one language, but for those of the contracting body; authors are its names.

    Broken XML gives an error and no chunks; null gives neither.
    """
    read = materialised(records.select(key, form_parts(language)(xml).alias("f")))
    texts = read.select(key, F.posexplode("f.texts").alias("order", "value"))
    return chunks_of(records, texts, key).join(read.select(key, F.coalesce("f.authors", F.array().cast("array<string>")).alias("authors"), "f.error"), key)


FORM = StructType([StructField("texts", ArrayType(StringType())), StructField("authors", ArrayType(StringType())), StructField("error", StringType())])


def parts_of_form(raw: bytes, language: str) -> tuple[list[str], list[str]]:
    """Paragraphs in document order, and the official names of the contracting body, each once and sorted."""
    texts, authors = [], set()
    for form in ElementTree.fromstring(raw).iter():
        if form.get("LG") != language or form.get("CATEGORY") != "ORIGINAL":
            continue
        waiting = [(form, False)]  # elements, and whether they are below a contracting body
        while waiting:
            node, body = waiting.pop()
            name = node.tag.rpartition("}")[2] if isinstance(node.tag, str) else ""
            if name == "OFFICIALNAME" and body and (told := " ".join((node.text or "").split())):
                authors.add(told)
            if name == "P" and not body:
                texts.append(" ".join(node.itertext()))
            waiting += [(child, body or name == "CONTRACTING_BODY") for child in reversed(node)]
    return texts, sorted(authors)


def form_parts(language: str):
    """A pandas UDF: struct of texts, authors and error of a column of XML (text or binary)."""

    @F.pandas_udf(FORM)
    def parts(column: pd.Series) -> pd.DataFrame:
        rows = []
        for raw in column:
            try:
                rows.append((None, None, None) if raw is None else (*parts_of_form(raw if isinstance(raw, str) else bytes(raw), language), None))
            except (ElementTree.ParseError, ValueError, LookupError) as error:
                rows.append((None, None, f"{type(error).__name__}: {error}"))
        return pd.DataFrame(rows, columns=["texts", "authors", "error"])

    return parts
