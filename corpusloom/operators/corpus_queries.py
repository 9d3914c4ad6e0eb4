"""Queries on documents and pages: scans, gates, deduplication, redaction, samples and statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.functions import markup
from corpusloom.functions import text as X
from corpusloom.functions import unicode as U
from corpusloom.operators import keep_first, near
from corpusloom.operators.gates import PROFILES, exact_keep_first, first_reason, profile_gates, sentence_gates
from corpusloom.plans import curate
from corpusloom.sources.files import table
from corpusloom.streaming import incremental

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


_KEY = "trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))"
_CLEAN = (
    "regexp_replace(regexp_replace(array_to_string(list_transform(regexp_split_to_array(regexp_replace(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f\\x{00AD}\\x{200B}]', '', 'g'), '\\r\\n|\\n|\\r'),"
    " lambda x: trim(regexp_replace(x, '[ \\t\\x{00A0}]+', ' ', 'g'))), chr(10)), '\\n{3,}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g')"
)
_LETTERS = "len(regexp_extract_all(text, '\\p{L}'))"
_EMAIL = "(?i)\\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{2,}\\b"


@query(f"""
WITH clean AS (SELECT doc_id, {_CLEAN} AS text FROM documents),
gated AS (SELECT doc_id, text, CASE WHEN length(text) < 200 THEN 'too_short' WHEN {_LETTERS} / greatest(1, length(text)) < 0.35 THEN 'low_letter_ratio' END AS reason FROM clean),
d AS (SELECT *, CASE WHEN reason IS NULL AND doc_id <> min(doc_id) OVER (PARTITION BY reason, {_KEY}) THEN 'duplicate' ELSE reason END AS final FROM gated)
SELECT coalesce(final, 'kept') AS decision, count(*) AS n, sum(length(text))::BIGINT AS n_chars FROM d GROUP BY 1
""")
def curate_documents(spark, sf_dir):
    done = curate.decisions(table(spark, sf_dir, "documents"))
    return done.groupBy(F.coalesce("reason", F.lit("kept")).alias("decision")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("n_chars"))


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def scan_project_sort(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars").orderBy("doc_id")


@query("SELECT doc_id, lang FROM documents WHERE lang = 'fr'")
def filter_language(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("lang = 'fr'").select("doc_id", "lang")


_SENTENCE = f"""
units AS (SELECT doc_id, text FROM documents),
g AS (SELECT doc_id, CASE WHEN length(text) < 12 THEN 'too_short' WHEN length(text) > 500 THEN 'too_long'
  WHEN regexp_matches(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]') THEN 'control_character' WHEN regexp_matches(text, '<[^>]{{1,120}}>') THEN 'html'
  WHEN regexp_matches(text, '(?i)\\b(https?://|www\\.)\\S+') THEN 'url' WHEN regexp_matches(text, '{_EMAIL}') THEN 'email'
  WHEN regexp_matches(text, '(^|[^0-9])[0-9]{{11}}([^0-9]|$)') THEN 'pesel_like'
  WHEN regexp_matches(text, '(^|[^0-9])(\\+?48[ .-]?)?([0-9][ .-]?){{8}}[0-9][ .-]?([^0-9]|$)') THEN 'phone_like'
  WHEN {_LETTERS} < 6 OR {_LETTERS} / greatest(1, length(text)) < 0.45 THEN 'low_letter_ratio' END AS reason FROM units)
"""


@query(f"WITH {_SENTENCE} SELECT doc_id, reason FROM g")
def gate_reasons(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", first_reason(sentence_gates(F.col("text"))).alias("reason"))


@query(" UNION ALL ".join(
    f"SELECT '{p.name}' AS profile, doc_id, CASE "
    + (f"WHEN len(regexp_extract_all(text, '\\x{{FFFD}}')) > {p.replacement} THEN 'replacement_characters' " if p.replacement is not None else "")
    + f"WHEN length(text) < {p.least_chars} THEN 'too_short' "
    + (f"WHEN {_LETTERS} / greatest(1, length(text)) < {p.ratio} THEN 'low_letter_ratio' " if p.ratio else "")
    + "END AS reason FROM documents" for p in PROFILES))
def gate_matrix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    each = F.explode(F.array(*(F.struct(F.lit(p.name).alias("profile"), first_reason(profile_gates(p, F.col("text"), F.col("lang"))).alias("reason")) for p in PROFILES)))
    return docs.select("doc_id", each.alias("g")).select("g.profile", "doc_id", "g.reason")


@query(f"SELECT doc_id, {_LETTERS}::BIGINT AS letters, {_LETTERS} / greatest(1, length(text)) AS ratio FROM documents")
def letter_ratio(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.letters(F.col("text")).cast("bigint").alias("letters"), X.letter_ratio(F.col("text")).alias("ratio"))


@query("""SELECT count(*) FILTER (lang NOT IN ('en','fr','de','es')) AS wrong_lang, count(*) FILTER (n_chars <> length(text)) AS wrong_length,
count(*) FILTER (source IS NULL OR source = '') AS no_source, count(*) AS n FROM documents""")
def contract_violations(spark, sf_dir):
    return table(spark, sf_dir, "documents").agg(
        F.count_if(~F.col("lang").isin("en", "fr", "de", "es")).alias("wrong_lang"), F.count_if(F.col("n_chars") != F.length("text")).alias("wrong_length"),
        F.count_if(F.col("source").isNull() | (F.col("source") == "")).alias("no_source"), F.count(F.lit(1)).alias("n"),
    )


@query("SELECT doc_id FROM documents WHERE contains(lower(source || ' ' || text), 'licen') OR contains(lower(source || ' ' || text), 'copyright')")
def keyword_any(spark, sf_dir):
    hay = F.lower(F.concat_ws(" ", "source", "text"))
    return table(spark, sf_dir, "documents").where(F.exists(F.array(F.lit("licen"), F.lit("copyright")), lambda k: F.contains(hay, k))).select("doc_id")


@query(f"SELECT doc_id, nullif(min(doc_id) OVER (PARTITION BY {_KEY}), doc_id) AS duplicate_of FROM documents")
def exact_dedup_keep_first(spark, sf_dir):
    return exact_keep_first(table(spark, sf_dir, "documents").select("doc_id", "text"), X.text_key(F.col("text")), "doc_id").select("doc_id", "duplicate_of")


@query("""WITH k AS (SELECT *, md5(text) AS key FROM documents)
SELECT key, count(*) AS n, sum(n_chars)::BIGINT AS total_chars, max(n_chars) AS longest, count(DISTINCT source) AS n_sources, min(doc_id) AS first_id, arg_min(source, doc_id) AS first_source FROM k GROUP BY key""")
def dedup_groups_argmin(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.md5("text").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("total_chars"), F.max("n_chars").alias("longest"), F.count_distinct("source").alias("n_sources"),
        F.min("doc_id").alias("first_id"), F.min_by("source", "doc_id").alias("first_source"),
    )


_LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents)"


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


@query(f"""WITH {_LINES}, u AS (SELECT doc_id, pos, line, row_number() OVER (PARTITION BY doc_id, trim(regexp_replace(lower(line), '\\s+', ' ', 'g')) ORDER BY pos) AS k FROM lines WHERE length(line) >= 20)
SELECT doc_id, pos, line FROM u WHERE k = 1""")
def chunk_dedup(spark, sf_dir):
    chunks = _lines(spark, sf_dir).where(F.length("line") >= 20).withColumn("key", X.text_key(F.col("line")))
    first = chunks.groupBy("doc_id", "key").agg(F.min(F.struct("pos", "line")).alias("x"))
    return first.select("doc_id", F.col("x.pos").cast("bigint").alias("pos"), "x.line")


_COMMON = "n AS (SELECT greatest(10, count(*) // 100) AS least FROM documents), common AS (SELECT md5(line) AS h, count(DISTINCT doc_id) AS df FROM lines WHERE length(line) >= 20 GROUP BY 1 HAVING count(DISTINCT doc_id) >= (SELECT least FROM n))"


def _common(spark, sf_dir):
    lines = _lines(spark, sf_dir).where(F.length("line") >= 20).select(F.md5("line").alias("h"), "doc_id").distinct()
    least = table(spark, sf_dir, "documents").agg(F.greatest(F.lit(10), F.floor(F.count(F.lit(1)) / 100).cast("bigint")).alias("least"))
    counts = lines.groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    return counts.join(F.broadcast(least), F.col("df") >= F.col("least")).select("h", "df")  # one row is broadcast


@query(f"WITH {_LINES}, {_COMMON} SELECT h, df FROM common")
def boilerplate_df(spark, sf_dir):
    """Lines that occur in at least 1 % of the documents, and ten."""
    return _common(spark, sf_dir)


@query(f"""WITH {_LINES}, {_COMMON}, kept AS (SELECT doc_id, pos, line FROM lines WHERE length(line) < 20 OR md5(line) NOT IN (SELECT h FROM common))
SELECT d.doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos), '') AS text FROM documents d LEFT JOIN kept USING (doc_id) GROUP BY d.doc_id""")
def boilerplate_removed(spark, sf_dir):
    lines = _lines(spark, sf_dir).withColumn("h", F.when(F.length("line") >= 20, F.md5("line")))
    hits = lines.join(_common(spark, sf_dir), "h", "left_semi").groupBy("doc_id").agg(F.collect_set("pos").alias("gone"))
    whole = table(spark, sf_dir, "documents").select("doc_id", "text").join(hits, "doc_id", "left")
    text = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.coalesce(F.array_contains("gone", i), F.lit(False))), "\n")
    return whole.select("doc_id", text.alias("text"))


@query(f"SELECT doc_id, len(regexp_extract_all(text, '{_EMAIL}'))::BIGINT AS email FROM documents")
def pii_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.redaction_counts(F.col("text"))["email"].cast("bigint").alias("email"))


@query()
def pii_redacted(spark, sf_dir):
    counts = X.redaction_counts(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", X.redacted(F.col("text")).alias("text"), *(c.alias(k) for k, c in counts.items()))


@query()
def pii_tags(spark, sf_dir):
    tags = X.pii_tags(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", tags.alias("tags"), F.when(tags == "", "uncertain").otherwise("yes").alias("contains_pii"))


_PAIRS = """tok AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM tok WHERE len(w) >= 5),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
pairs AS (SELECT a, b, shared, shared / (p.n + q.n - shared) AS jaccard FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE shared / (p.n + q.n - shared) >= 0.9)"""


@query(f"WITH {_PAIRS} SELECT a, b, shared, jaccard FROM pairs")
def shingles_exact_jaccard(spark, sf_dir):
    return near.jaccard_pairs(table(spark, sf_dir, "documents"))


GREEDY = f"""WITH RECURSIVE {_PAIRS},
nodes AS (SELECT id, row_number() OVER (ORDER BY id) AS i FROM (SELECT a AS id FROM pairs UNION SELECT b FROM pairs)),
earlier AS (SELECT n.i, n.id, coalesce(list(p.a) FILTER (p.a IS NOT NULL), []) AS others FROM nodes n LEFT JOIN pairs p ON p.b = n.id GROUP BY n.i, n.id),
walk AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS kept UNION ALL
    SELECT e.i, CASE WHEN list_has_any(w.kept, e.others) THEN w.kept ELSE list_append(w.kept, e.id) END FROM walk w JOIN earlier e ON e.i = w.i + 1),
gone AS (SELECT p.b AS doc_id, arg_min(p.a, p.a::VARCHAR) AS duplicate_of FROM pairs p, (SELECT kept FROM walk ORDER BY i DESC LIMIT 1)
    WHERE list_contains(kept, p.a) AND NOT list_contains(kept, p.b) GROUP BY p.b)"""


@query(f"{GREEDY} SELECT doc_id, duplicate_of FROM gone")
def near_dedup_greedy(spark, sf_dir):
    """Candidates by pieces of sets, which lose no pair."""
    return keep_first.near_dedup(table(spark, sf_dir, "documents"), lsh=None).select(F.col("id").alias("doc_id"), "duplicate_of")


@query(f"{GREEDY} SELECT doc_id, duplicate_of FROM gone")
def near_dedup_textbooks(spark, sf_dir):
    """Bands for a likeness of 0.8; texts without a shingle stay."""
    return keep_first.near_dedup(table(spark, sf_dir, "documents"), lsh=0.8).select(F.col("id").alias("doc_id"), "duplicate_of")


@query(f"""{GREEDY}, bare AS (SELECT doc_id, min(doc_id) OVER () AS first FROM tok WHERE len(w) < 5)
SELECT doc_id, duplicate_of FROM gone UNION ALL SELECT doc_id, first FROM bare WHERE doc_id <> first""")
def near_dedup_notices(spark, sf_dir):
    """Bands for a likeness of 0.86; texts without a shingle are copies of one another."""
    return keep_first.near_dedup(table(spark, sf_dir, "documents"), lsh=0.86, empty_alike=True).select(F.col("id").alias("doc_id"), "duplicate_of")


@query(f"WITH {_PAIRS} SELECT a, b, shared, jaccard FROM pairs")
def near_dedup_lsh(spark, sf_dir):
    return near.lsh_pairs(table(spark, sf_dir, "documents"))


@query("""WITH b AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS w FROM benchmark) WHERE len(w) >= 5),
d AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS w FROM documents) WHERE len(w) >= 5)
SELECT item_id, doc_id, count(*) AS shared FROM b JOIN d USING (s) GROUP BY 1, 2 HAVING count(*) >= 5""")
def benchmark_overlap(spark, sf_dir):
    """Documents that share five or more five-word runs with a benchmark item."""
    items = near.materialised(near.shingle_sets(table(spark, sf_dir, "benchmark"), "item_id"))
    few = items.count() <= near.BROADCAST_ROWS
    known = items.select("s").distinct()
    docs = keep_first.sets_of(table(spark, sf_dir, "documents"), "doc_id").select(F.col("id").alias("doc_id"), F.explode_outer("set").alias("s"))
    met = docs.join(F.broadcast(known) if few else known, "s", "left_semi")  # of the documents' shingles only these move
    return met.join(F.broadcast(items) if few else items, "s").groupBy("item_id", "doc_id").agg(F.count(F.lit(1)).alias("shared")).where("shared >= 5")


@query("SELECT source, avg((lang = 'en')::INT) AS share, count(*) AS n FROM documents GROUP BY source")
def language_share(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.avg((F.col("lang") == "en").cast("double")).alias("share"), F.count(F.lit(1)).alias("n"))


_TOKENS = "round_even(greatest(length(text) / 3.5, len(regexp_extract_all(text, '\\S+')) * 1.5), 0)::BIGINT"


@query(f"SELECT doc_id, {_TOKENS} AS token_count FROM documents")
def token_proxy(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.token_proxy(F.col("text")).alias("token_count"))


@query("""SELECT lang, min(n_chars) AS least, quantile_cont(n_chars, 0.1) AS p10, quantile_cont(n_chars, 0.5) AS p50, quantile_cont(n_chars, 0.9) AS p90,
quantile_cont(n_chars, 0.99) AS p99, max(n_chars) AS most, avg(n_chars) AS mean FROM documents GROUP BY lang""")
def length_quantiles(spark, sf_dir):
    quantiles = (F.percentile("n_chars", q).alias(f"p{round(q * 100)}") for q in (0.1, 0.5, 0.9, 0.99))
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.min("n_chars").alias("least"), *quantiles, F.max("n_chars").alias("most"), F.avg("n_chars").alias("mean"))


def _sample_rank():
    return F.sha2(F.concat(F.lit("sample:"), F.col("doc_id").cast("string")), 256)


@query("SELECT doc_id, sha256('sample:' || doc_id) AS h FROM documents ORDER BY h LIMIT 12")
def hash_sample_12(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", _sample_rank().alias("h")).orderBy("h").limit(12)


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY sha256('sample:' || doc_id)) AS k FROM documents) WHERE k <= 3")
def hash_sample_per_source_3(spark, sf_dir):
    k = F.row_number().over(Window.partitionBy("source").orderBy(_sample_rank()))
    return table(spark, sf_dir, "documents").select("source", "doc_id").withColumn("k", k).where("k <= 3").drop("k")


@query(f"SELECT doc_id, {_TOKENS} AS token_count FROM documents ORDER BY abs(token_count - 1500), sha256('sample:' || doc_id) LIMIT 12")
def hash_sample_near_1500(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", X.token_proxy(F.col("text")).alias("token_count"))
    return rows.orderBy(F.abs(F.col("token_count") - 1500), _sample_rank()).limit(12)


@query(f"""SELECT count(*) AS n, count(DISTINCT text) AS n_texts, sum(length(text))::BIGINT AS chars, sum(len(regexp_extract_all(text, '\\S+')))::BIGINT AS words, sum({_TOKENS})::BIGINT AS tokens,
bool_and(n_chars = length(text)) AS lengths_right, bool_or(text = '') AS any_empty, coalesce(min(CASE WHEN lang <> 'unknown' THEN lang END), 'unknown') AS first_lang FROM documents""")
def stats_block(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(F.sha2("text", 256)).alias("n_texts"), F.sum(F.length(text)).alias("chars"), F.sum(X.word_count(text)).alias("words"),
        F.sum(X.token_proxy(text)).alias("tokens"), F.bool_and(F.col("n_chars") == F.length(text)).alias("lengths_right"), F.bool_or(text == "").alias("any_empty"),
        F.coalesce(F.min(F.when(F.col("lang") != "unknown", F.col("lang"))), F.lit("unknown")).alias("first_lang"),
    )


@query("""SELECT 'lang' AS field, lang AS value, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source
UNION ALL SELECT 'quality', quality::VARCHAR, count(*) FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality""")
def value_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    pairs = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in ("lang", "source", "quality")))
    return rows.select(F.explode(pairs).alias("x")).groupBy("x.field", "x.value").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT md5(text) AS h, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, h LIMIT 10")
def duplicates_having(spark, sf_dir):
    """The ten texts with most copies."""
    return table(spark, sf_dir, "documents").groupBy(F.md5("text").alias("h")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy(F.desc("n"), "h").limit(10)


@query(f"SELECT doc_id, source || '_' || sha256({_KEY}) AS id FROM documents")
def canonical_id(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.content_id(F.col("source"), X.text_key(F.col("text"))).alias("id"))


@query(f"""WITH {_LINES}, marked AS (SELECT *, bool_or(length(line) > 400) OVER (PARTITION BY doc_id ORDER BY pos) AS over FROM lines)
SELECT doc_id, count(*) FILTER (NOT over) AS n_lines, coalesce(sum(length(line)) FILTER (NOT over), 0)::BIGINT AS n_chars FROM marked GROUP BY doc_id""")
def stop_after_marker(spark, sf_dir):
    """Lines before the first marker line, here one of over 400 code points; by array functions, so texts needn't be sorted."""
    lines = F.split("text", "\n")
    first = F.array_position(F.transform(lines, lambda x: F.length(x) > 400), True)
    before = F.when(first > 0, F.slice(lines, F.lit(1), (first - 1).cast("int"))).otherwise(lines)
    return table(spark, sf_dir, "documents").select("doc_id", F.size(before).cast("bigint").alias("n_lines"), F.aggregate(before, F.lit(0).cast("bigint"), lambda n, x: n + F.length(x)).alias("n_chars"))


@query(f"""WITH {_LINES}, p AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM lines)
SELECT doc_id, count(*) FILTER (before IS DISTINCT FROM line) AS n_blocks FROM p GROUP BY doc_id""")
def consecutive_duplicates(spark, sf_dir):
    """Blocks left once each that equals the kept one before it is dropped."""
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda x, i: (i == 0) | (x != F.get(lines, i - 1)))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(kept).cast("bigint").alias("n_blocks"))


@query("SELECT page_id, regexp_extract(url, '^(https?)://', 1) AS scheme, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, len(regexp_extract_all(html, '(?i)<a\\s[^>]*href=')) AS n_links FROM pages")
def page_hosts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", "^(https?)://", 1).alias("scheme"), F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("host"),
        F.regexp_count("html", F.lit(r"(?i)<a\s[^>]*href=")).cast("bigint").alias("n_links"),
    )


@query("""SELECT DISTINCT page_id, unnest(list_transform(regexp_extract_all(html, '<a href="([^"#]*)', 1), lambda l: regexp_extract(url, '^(https?://[^/?#]+)', 1) || l)) AS link FROM pages""")
def html_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(markup.html_links("html", "url")).alias("link"))


@query()
def html_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", markup.html_text("html").alias("text"))


@query()
def unicode_keys(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(U.folded_key("text"), 256).alias("key"), F.sha2(U.title_key("text"), 256).alias("title_key"))


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def resume_incremental(spark, sf_dir):
    return incremental.hourly_events(spark, sf_dir)
