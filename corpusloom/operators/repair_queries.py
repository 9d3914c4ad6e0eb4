"""Queries on mended texts, slices, classes, fallback rows, and comparisons of tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import repair as R
from corpusloom.functions import text as X
from corpusloom.operators.contracts import counter_totals, registry_diff
from corpusloom.sources.files import table

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def also(df, rows):
    """``df`` and rows that hit a rule which the tables' rows seldom do."""
    return df.unionByName(df.sparkSession.createDataFrame(rows, df.schema))


def _values(rows):
    written = lambda x: "NULL" if x is None else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    return "VALUES " + ", ".join("(" + ", ".join(map(written, row)) + ")" for row in rows)


#: Texts with page numbers, split words and wrapped lines, with and without blanks around them.
_LINES = [(-1, "koniec strony  \n 12 \ni dalej pra- \nca"), (-2, "Pra-\nca jest\nważna.\n17\nDalej\n\n\n\n\nkoniec "), (-3, "12345\nx-\nY\t\n a:\nb;\nc\nd"), (-4, " \n7\n"), (-5, "a\t b  c\n  d")]
_FORMULAS = [(-1, "\\( x \\)"), (-2, "\\[ x \\] \\("), (-3, "\\[ x"), (-4, "( x ] \\)"), (-5, "")]
_AUTHORS = [(-10 - k, None if k % 2 else f"Podpis: {own[-1].upper()}", f"pismo, {own[0]}") for k, own in enumerate(R.AUTHORS.values())] + [(-1, "", "x" * 4000 + " fundacja"), (-2, "Fundacja i izba", "")]
_DATES = [(-1, "D:19891231"), (-2, "D:20251301"), (-3, "D:20250132"), (-4, "2025"), (-5, "D:19900101120000"), (-6, "x D:20251231"), (-7, ""), (-8, None)]
_SETS = [("only en", "en"), ("en and es", "en"), ("en and es", "es"), ("fr and de", "fr"), ("fr and de", "de"), ("en and de", "de"), ("en and de", "en"), ("none", None)]


def _twice(column: str, pattern: str, by: str) -> str:
    """The SQL dialect has no look-behind: neighbouring matches share a letter, so the second of them needs a second pass."""
    return f"regexp_replace(regexp_replace({column}, '{pattern}', '{by}', 'g'), '{pattern}', '{by}', 'g')"


@query(f"""WITH a AS (SELECT doc_id, coalesce(array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_full_match(x, '[0-9]{{1,4}}')), chr(10)), '') AS t
    FROM (SELECT doc_id, array_to_string(list_transform(regexp_split_to_array(text, '\\r\\n|\\n|\\r'), lambda x: regexp_replace(regexp_replace(x, '[ \\t\\x{{00A0}}]+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')), chr(10)) AS text
        FROM (SELECT doc_id, text FROM documents UNION ALL {_values(_LINES)}))),
b AS (SELECT doc_id, {_twice('t', '([' + chr(92) + 'p{L}' + chr(92) + 'p{N}_])-' + chr(92) + 'n([' + R.SMALL + '])', chr(92) + '1' + chr(92) + '2')} AS t FROM a),
c AS (SELECT doc_id, {_twice('t', '(^|[^' + R.ENDS + chr(92) + 'n])' + chr(92) + 'n([' + R.SMALL + '])', chr(92) + '1 ' + chr(92) + '2')} AS t FROM b),
d AS (SELECT doc_id, trim(regexp_replace(regexp_replace(t, '[ \\t]+\\n', chr(10), 'g'), '\\n{{4,}}', chr(10) || chr(10) || chr(10), 'g'), chr(32) || chr(9) || chr(10) || chr(13)) AS t FROM c)
SELECT doc_id, length(t)::BIGINT AS n, sha256(CASE WHEN t = '' THEN t ELSE t || chr(10) END) AS text_sha256 FROM d""")
def repaired_lines(spark, sf_dir):
    docs = also(table(spark, sf_dir, "documents").select("doc_id", "text"), _LINES)
    done = docs.select("doc_id", R.repaired(F.coalesce("text", F.lit(""))).alias("t"))
    return done.select("doc_id", F.greatest(F.length("t") - 1, F.lit(0)).cast("bigint").alias("n"), F.sha2("t", 256).alias("text_sha256"))


@query(f"SELECT doc_id, w.n AS n, sha256(left(text, w.n)) AS head_sha256 FROM documents, (SELECT unnest([{', '.join(map(str, R.WINDOWS))}]) AS n) w WHERE text IS NOT NULL")
def prefix_windows(spark, sf_dir):
    heads = F.array(*(F.struct(F.lit(n).alias("n"), F.sha2(F.left("text", F.lit(n)), 256).alias("head_sha256")) for n in R.WINDOWS))
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.inline(heads))


@query("WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents) SELECT doc_id, md5(array_to_string(list_concat(p[1:3], p[greatest(len(p) - 2, 1):]), chr(10))) AS ends, len(p)::BIGINT AS n FROM p")
def first_and_last_lines(spark, sf_dir):
    lines = F.split("text", "\n")
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.array_join(R.both_ends(lines), "\n")).alias("ends"), F.size(lines).cast("bigint").alias("n"))


@query("""WITH n AS (SELECT page_id, url, string_split(url, '/')[-1] AS name FROM pages), s AS (SELECT *, regexp_extract(name, '.(\\.[^.]+)$', 1) AS suffix FROM n)
SELECT page_id, name, suffix, left(name, length(name) - length(suffix)) AS stem, string_split(url, ':')[-1] AS behind_colon FROM s""")
def path_parts(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", R.path_name(url).alias("name"), R.path_suffix(url).alias("suffix"), R.path_stem(url).alias("stem"), F.substring_index(url, ":", -1).alias("behind_colon")
    )


_HEAD = "lower(concat_ws(chr(10), source, left(text, 4000)))"


@query("SELECT doc_id, CASE " + " ".join(f"WHEN {' OR '.join(f'contains({_HEAD}, {term!r})' for term in terms)} THEN '{name}'" for name, terms in R.AUTHORS.items()) + f" ELSE 'unknown' END AS kind FROM (SELECT doc_id, source, text FROM documents UNION ALL {_values(_AUTHORS)})")
def author_kinds(spark, sf_dir):
    return also(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), _AUTHORS).select("doc_id", R.author_kind(F.col("source"), F.col("text")).alias("kind"))


@query(f"SELECT doc_id, length(text) - length(replace(text, '\\(', '')) <> length(text) - length(replace(text, '\\)', '')) OR length(text) - length(replace(text, '\\[', '')) <> length(text) - length(replace(text, '\\]', '')) AS unbalanced FROM (SELECT doc_id, text FROM documents UNION ALL {_values(_FORMULAS)})")
def math_unbalanced(spark, sf_dir):
    return also(table(spark, sf_dir, "documents").select("doc_id", "text"), _FORMULAS).select("doc_id", R.unbalanced_math(F.col("text")).alias("unbalanced"))


@query("SELECT event_id, sha256(json(props)::VARCHAR) AS props_sha256 FROM events")
def canonical_json_hash(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", R.canonical_sha256("props").alias("props_sha256"))


@query(f"""WITH r AS (SELECT event_id, regexp_extract(raw, 'D:([0-9]{{8}})', 1) AS d FROM (SELECT event_id, strftime(ts, 'D:%Y%m%d%H%M%S') AS raw FROM events UNION ALL {_values(_DATES)})),
p AS (SELECT event_id, try_cast(d[1:4] AS INT) AS y, try_cast(d[5:6] AS INT) AS m, try_cast(d[7:8] AS INT) AS n, d[1:4] || '-' || d[5:6] || '-' || d[7:8] AS day FROM r)
SELECT event_id, CASE WHEN y BETWEEN 1990 AND year(current_date) AND m BETWEEN 1 AND 12 AND n BETWEEN 1 AND 31 THEN day ELSE 'unknown' END AS created FROM p""")
def pdf_dates(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("D:"), F.date_format("ts", "yyyyMMddHHmmss")).alias("raw"))
    return also(raw, _DATES).select("event_id", R.pdf_date(F.col("raw")).alias("created"))


@query(f"SELECT source FROM (SELECT source, lang FROM documents UNION ALL {_values(_SETS)}) GROUP BY source HAVING bool_or(lang = 'en') AND bool_or(lang IN ('fr', 'de'))")
def multi_valued_membership(spark, sf_dir):
    sets = also(table(spark, sf_dir, "documents").select("source", "lang"), _SETS).groupBy("source").agg(F.collect_set("lang").alias("langs"))
    return sets.where(F.array_contains("langs", "en") & F.arrays_overlap("langs", F.array(F.lit("fr"), F.lit("de")))).select("source")


def queue(rows, priority: int):
    """Rows of one priority, given as text; 0 stands for all."""
    number = F.col("priority").try_cast("int")
    return (rows if priority <= 0 else rows.where(number == priority)).withColumn("priority", number)


@query("SELECT o_orderkey, left(o_orderpriority, 1)::INT AS priority FROM orders WHERE left(o_orderpriority, 1)::INT = 2 ORDER BY priority, o_orderkey")
def queue_of_priority(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.left("o_orderpriority", F.lit(1)).alias("priority"))
    return queue(rows, 2).orderBy("priority", "o_orderkey")


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN -1 ELSE l.quality END AS quality, CASE WHEN l.doc_id IS NULL THEN -1 ELSE l.toxic END AS toxic, l.doc_id IS NOT NULL AS replaced FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def fallback_replace(spark, sf_dir):
    """The whole right row, where there is one, takes the place of the left one, with its nulls."""
    left = table(spark, sf_dir, "documents").select("doc_id", F.struct(F.lit(-1).alias("quality"), F.lit(-1).alias("toxic")).alias("own"))
    right = table(spark, sf_dir, "labels").select("doc_id", F.struct("quality", "toxic").alias("other"))
    return left.join(right, "doc_id", "left").select("doc_id", F.coalesce("other", "own").alias("r"), F.col("other").isNotNull().alias("replaced")).select("doc_id", "r.*", "replaced")


@query("SELECT list_sort(list(DISTINCT lang)) = ['de', 'en', 'es', 'fr'] AS complete, count(DISTINCT lang)::BIGINT AS n FROM documents")
def group_coverage(spark, sf_dir):
    langs = F.array_sort(F.collect_set("lang"))
    return table(spark, sf_dir, "documents").agg((langs == F.array(*map(F.lit, ("de", "en", "es", "fr")))).alias("complete"), F.size(langs).cast("bigint").alias("n"))


@query("""WITH c AS (SELECT unnest([{'key': 'letters', 'n': len(regexp_extract_all(text, '\\p{L}'))}, {'key': 'lines', 'n': len(string_split(text, chr(10)))}, {'key': 'words', 'n': len(regexp_extract_all(text, '\\S+'))}]) AS c FROM documents)
SELECT c.key AS key, sum(c.n)::BIGINT AS total FROM c GROUP BY 1""")
def counters_summed(spark, sf_dir):
    text = F.col("text")
    counts = {"letters": X.letters(text), "lines": F.size(F.split(text, "\n")), "words": X.word_count(text)}
    rows = table(spark, sf_dir, "documents").select(F.create_map(*(x for k, v in counts.items() for x in (F.lit(k), v.cast("bigint")))).alias("counters"))
    return counter_totals(rows, "counters")


@query("SELECT event_id, user_id FROM events WHERE event_type = 'error' ORDER BY event_id LIMIT 20")
def first_errors(spark, sf_dir):
    return table(spark, sf_dir, "events").where("event_type = 'error'").select("event_id", "user_id").orderBy("event_id").limit(20)


@query("""SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN a.doc_id IS NULL THEN 'added' WHEN b.doc_id IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM (SELECT doc_id, lang FROM documents WHERE lang IS DISTINCT FROM 'fr') a FULL JOIN (SELECT doc_id, CASE WHEN lang = 'de' THEN 'xx' ELSE lang END AS lang FROM documents WHERE lang IS DISTINCT FROM 'es') b ON a.doc_id = b.doc_id
WHERE a.doc_id IS NULL OR b.doc_id IS NULL OR a.lang IS DISTINCT FROM b.lang""")
def registry_changes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    before = docs.where(~F.col("lang").eqNullSafe("fr"))
    after = docs.where(~F.col("lang").eqNullSafe("es")).withColumn("lang", F.when(F.col("lang") == "de", "xx").otherwise(F.col("lang")))
    return registry_diff(before, after, "doc_id")


@query("""WITH c AS (SELECT conv_id, list(DISTINCT role) AS roles FROM conversations GROUP BY 1) SELECT conv_id, len(list_filter(roles, lambda r: r NOT IN ('user', 'assistant'))) = 0 AS within FROM c""")
def subset_of_roles(spark, sf_dir):
    sets = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_set("role").alias("roles"))
    return sets.select("conv_id", (F.size(F.array_except("roles", F.array(F.lit("user"), F.lit("assistant")))) == 0).alias("within"))


@query("SELECT doc_id, md5(source || chr(10) || chr(10) || text) AS whole FROM documents")
def title_and_body(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.concat("source", F.lit("\n\n"), "text")).alias("whole"))
