"""Queries on review tables: queues, quotas, merges, constraints, hand-off, index, audits, lineage and deltas.

Review rows are documents with their labels; an unlabelled document hasn't been reviewed.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators.near import materialised
from corpusloom.operators.ordering import numbered
from corpusloom.sources.files import last_wins, table

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


_HINT = """CASE WHEN length(text) = 0 THEN 'not_extractable' WHEN length(text) < 500 OR len(regexp_extract_all(text, '\\S+')) < 80 THEN 'poor' WHEN length(text) < 1500 THEN 'usable' ELSE 'good' END"""
_PII = "CASE WHEN regexp_matches(text, '(?i)\\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{2,}\\b') THEN 'yes' ELSE 'uncertain' END"
_REVIEW = f"""o AS (SELECT doc_id, source, lang, length(text) AS chars, {_HINT} AS quality_hint, {_PII} AS pii,
  CASE WHEN lang = 'en' THEN 'organization_comment' ELSE 'other' END AS doc_type FROM documents),
obs AS (SELECT *, CASE WHEN pii = 'yes' THEN 'pii_first' WHEN quality_hint IN ('poor', 'not_extractable') THEN 'extraction_first' WHEN doc_type <> 'organization_comment' THEN 'scope_check' ELSE 'standard' END AS priority FROM o),
r AS (SELECT obs.*, l.quality, l.toxic, l.doc_id IS NOT NULL AS reviewed FROM obs LEFT JOIN labels l ON l.doc_id = obs.doc_id)"""


def observations(spark, sf_dir):
    text = F.col("text")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", F.length(text).alias("chars"),
        X.quality_hint(F.length(text), X.word_count(text), F.lit(0), F.lit("extracted")).alias("quality_hint"),
        F.when(text.rlike(X.EMAIL), "yes").otherwise("uncertain").alias("pii"),
        F.when(F.col("lang") == "en", "organization_comment").otherwise("other").alias("doc_type"),
    )
    return rows.withColumn("priority", X.review_priority(F.col("pii"), F.col("quality_hint"), F.col("doc_type")))


def reviewed(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").withColumn("reviewed", F.lit(True))
    return observations(spark, sf_dir).join(labels, "doc_id", "left").withColumn("reviewed", F.coalesce("reviewed", F.lit(False)))


_RANK = "CASE priority WHEN 'pii_first' THEN 1 WHEN 'extraction_first' THEN 2 WHEN 'scope_check' THEN 3 ELSE 4 END"


@query(f"""WITH {_REVIEW}, ranked AS (SELECT *, {_RANK} AS p FROM r WHERE NOT reviewed),
numbered AS (SELECT *, row_number() OVER (ORDER BY p, source, doc_id) AS n FROM ranked)
SELECT 'review-' || lpad(n::VARCHAR, greatest(4, length(n::VARCHAR))::INT, '0') AS queue_id, doc_id, p AS priority, source FROM numbered""")
def review_queue(spark, sf_dir):
    p = F.when(F.col("priority") == "pii_first", 1).when(F.col("priority") == "extraction_first", 2).when(F.col("priority") == "scope_check", 3).otherwise(4)
    rows = reviewed(spark, sf_dir).where("not reviewed").select("doc_id", p.alias("priority"), "source")
    done = numbered(rows, F.col("priority"), F.col("source"), F.col("doc_id"), name="n")
    return done.select(F.format_string("review-%04d", "n").alias("queue_id"), "doc_id", "priority", "source")


@query(f"""WITH {_REVIEW} SELECT doc_id, priority FROM (SELECT *, row_number() OVER (PARTITION BY priority ORDER BY doc_id) AS k FROM r) WHERE k <= 5""")
def priority_caps(spark, sf_dir):
    k = F.row_number().over(Window.partitionBy("priority").orderBy("doc_id"))
    return observations(spark, sf_dir).select("doc_id", "priority").withColumn("k", k).where("k <= 5").drop("k")


_QUOTAS = (("extraction_first", 2, 1), ("standard", 4, 2), ("pii_first", 4, 3), ("scope_check", 2, 4))


@query(f"""WITH {_REVIEW}, quota(priority, quota, bucket) AS (VALUES {', '.join(str(x) for x in _QUOTAS)}),
k AS (SELECT obs.doc_id, priority, quota, bucket, row_number() OVER (PARTITION BY priority ORDER BY doc_id) AS k FROM obs JOIN quota USING (priority)),
first AS (SELECT doc_id, priority, bucket, k FROM k WHERE k <= quota), rest AS (SELECT obs.doc_id, obs.priority, 9 AS bucket, row_number() OVER (ORDER BY obs.doc_id) AS k FROM obs WHERE obs.doc_id NOT IN (SELECT doc_id FROM first)),
both_parts AS (SELECT * FROM first UNION ALL SELECT * FROM rest), n AS (SELECT *, row_number() OVER (ORDER BY bucket, k) AS rank FROM both_parts)
SELECT rank, doc_id, priority FROM n WHERE rank <= 16""")
def calibration_quota(spark, sf_dir):
    """Quotas in the order of buckets, then filled up to 16 in the order of ids."""
    quota = spark.createDataFrame(_QUOTAS, "priority string, quota int, bucket int")
    rows = observations(spark, sf_dir).select("doc_id", "priority")
    k = F.row_number().over(Window.partitionBy("priority").orderBy("doc_id"))
    most = max(q for _, q, _ in _QUOTAS)
    first = rows.withColumn("k", k).where(F.col("k") <= most).join(F.broadcast(quota), "priority").where("k <= quota").select("doc_id", "priority", "bucket", "k")
    rest = rows.join(first.select("doc_id"), "doc_id", "left_anti").orderBy("doc_id").limit(16).select("doc_id", "priority", F.lit(9).alias("bucket"), F.col("doc_id").alias("k"))
    chosen = first.unionByName(rest).orderBy("bucket", "k").limit(16)
    return chosen.select(F.row_number().over(Window.orderBy("bucket", "k")).cast("bigint").alias("rank"), "doc_id", "priority")  # of 16 rows


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def remaining_anti(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id", "source")


@query("SELECT doc_id, quality, toxic FROM labels WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def semi_kept(spark, sf_dir):
    kept = table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id")
    return table(spark, sf_dir, "labels").join(kept, "doc_id", "left_semi").select("doc_id", "quality", "toxic")


@query(f"""WITH {_REVIEW}, u AS (SELECT doc_id, 0 AS quality, 1 AS toxic FROM r WHERE pii = 'yes'), e AS (SELECT count(*) AS n FROM u WHERE quality NOT IN (0, 1))
SELECT l.doc_id, CASE WHEN u.doc_id IS NOT NULL AND e.n = 0 THEN u.quality ELSE l.quality END AS quality, CASE WHEN u.doc_id IS NOT NULL AND e.n = 0 THEN u.toxic ELSE l.toxic END AS toxic, u.doc_id IS NOT NULL AND e.n = 0 AS changed
FROM labels l LEFT JOIN u ON u.doc_id = l.doc_id CROSS JOIN e""")
def merge_reviews(spark, sf_dir):
    """All updates or, if any has a value that isn't allowed, none."""
    updates = observations(spark, sf_dir).where("pii = 'yes'").select("doc_id", F.lit(0).alias("q"), F.lit(1).alias("t"))
    errors = updates.agg(F.count_if(~F.col("q").isin(0, 1)).alias("errors"))
    rows = table(spark, sf_dir, "labels").join(updates, "doc_id", "left").join(F.broadcast(errors), how="cross")  # one row
    go = F.col("q").isNotNull() & (F.col("errors") == 0)
    return rows.select("doc_id", F.when(go, F.col("q")).otherwise(F.col("quality")).alias("quality"), F.when(go, F.col("t")).otherwise(F.col("toxic")).alias("toxic"), go.alias("changed"))


@query(f"""WITH {_REVIEW}, a AS (SELECT doc_id, CASE WHEN toxic = 0 THEN 'include' ELSE 'exclude' END AS rec, CASE WHEN quality = 1 THEN 'eligible' ELSE 'review_needed' END AS legal, CASE WHEN lang = 'en' THEN 'own work' ELSE 'needs Review' END AS basis, pii, reviewed FROM r)
SELECT doc_id, concat_ws(';', CASE WHEN NOT reviewed THEN 'missing_reviewer' END, CASE WHEN legal = 'eligible' AND contains(lower(basis), 'review') THEN 'legal_basis' END, CASE WHEN rec = 'include' AND legal <> 'eligible' THEN 'include_needs_eligible' END, CASE WHEN pii = 'yes' AND rec = 'include' THEN 'include_with_pii' END) AS errors FROM a""")
def review_constraints(spark, sf_dir):
    rows = reviewed(spark, sf_dir).select(
        "doc_id", "reviewed", "pii", F.when(F.col("toxic") == 0, "include").otherwise("exclude").alias("rec"),
        F.when(F.col("quality") == 1, "eligible").otherwise("review_needed").alias("legal"), F.when(F.col("lang") == "en", "own work").otherwise("needs Review").alias("basis"),
    )
    errors = F.array_compact(F.array(
        F.when(~F.col("reviewed"), "missing_reviewer"),
        F.when((F.col("legal") == "eligible") & F.lower("basis").contains("review"), "legal_basis"),
        F.when((F.col("rec") == "include") & (F.col("legal") != "eligible"), "include_needs_eligible"),
        F.when((F.col("pii") == "yes") & (F.col("rec") == "include"), "include_with_pii"),
    ))
    return rows.select("doc_id", F.array_join(errors, ";").alias("errors"))


@query(f"""WITH {_REVIEW}, h AS (SELECT doc_id, reviewed, toxic, concat_ws(';', CASE WHEN coalesce(quality, 0) <> 1 THEN 'legal_review_needed' END, CASE WHEN pii = 'yes' THEN 'pii_scrub_needed' END,
CASE WHEN quality_hint IN ('poor', 'not_extractable') THEN 'extraction_quality_review_needed' END, CASE WHEN NOT reviewed THEN 'human_review_needed' END) AS b FROM r)
SELECT doc_id, CASE WHEN toxic = 1 THEN 'exclude_from_training_candidate' WHEN NOT reviewed THEN 'draft_candidate_do_not_train' ELSE 'reviewed_candidate_blocked_until_clearance' END AS decision,
CASE WHEN toxic = 1 AND b = '' THEN 'excluded_by_review' ELSE b END AS blockers FROM h""")
def handoff_decision(spark, sf_dir):
    blockers = F.concat_ws(
        ";", F.when(F.coalesce("quality", F.lit(0)) != 1, "legal_review_needed"), F.when(F.col("pii") == "yes", "pii_scrub_needed"),
        F.when(F.col("quality_hint").isin("poor", "not_extractable"), "extraction_quality_review_needed"), F.when(~F.col("reviewed"), "human_review_needed"),
    )
    excluded = F.col("toxic") == 1
    decision = F.when(excluded, "exclude_from_training_candidate").when(~F.col("reviewed"), "draft_candidate_do_not_train").otherwise("reviewed_candidate_blocked_until_clearance")
    return reviewed(spark, sf_dir).select("doc_id", decision.alias("decision"), F.when(excluded & (blockers == ""), "excluded_by_review").otherwise(blockers).alias("blockers"))


@query(f"""WITH {_REVIEW}, m AS (SELECT md5(text) AS digest, arg_max(source, doc_id) AS origin FROM documents GROUP BY 1),
c AS (SELECT r.doc_id, m.origin, CASE WHEN r.toxic = 1 THEN '3_exclusion_confirmation' WHEN r.pii IN ('yes', 'uncertain') THEN '1_training_candidate_with_pii' ELSE '2_training_candidate_low_pii' END AS legal_priority
 FROM r JOIN documents d ON d.doc_id = r.doc_id LEFT JOIN m ON m.digest = md5(d.text) WHERE r.reviewed AND r.quality = 0)
SELECT 'legal-' || lpad(k::VARCHAR, greatest(4, length(k::VARCHAR))::INT, '0') AS legal_id, doc_id, origin, legal_priority FROM (SELECT *, row_number() OVER (ORDER BY legal_priority, origin, doc_id) AS k FROM c)""")
def legal_queue(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5("text").alias("digest"))
    manifest = last_wins(docs, "digest", "doc_id").select("digest", F.col("source").alias("origin"))
    rows = reviewed(spark, sf_dir).where("reviewed and quality = 0").select("doc_id", "toxic", "pii").join(docs.select("doc_id", "digest"), "doc_id").join(manifest, "digest", "left")
    level = F.when(F.col("toxic") == 1, "3_exclusion_confirmation").when(F.col("pii").isin("yes", "uncertain"), "1_training_candidate_with_pii").otherwise("2_training_candidate_low_pii")
    done = numbered(rows.select("doc_id", "origin", level.alias("legal_priority")), F.col("legal_priority"), F.col("origin"), F.col("doc_id"), name="k")
    return done.select(F.format_string("legal-%04d", "k").alias("legal_id"), "doc_id", "origin", "legal_priority")


_INDEX = f"""idx AS (SELECT 'b' || (doc_id % 3) AS batch, doc_id, source, coalesce(nullif(CASE WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'bad' ELSE '' END, ''), quality_hint) AS quality, chars, chars > 0 AS has_text, reviewed FROM r)"""


def _index(spark, sf_dir):
    human = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "bad").otherwise("")
    return reviewed(spark, sf_dir).select(
        F.concat(F.lit("b"), (F.col("doc_id") % 3).cast("string")).alias("batch"), "doc_id", "source", F.coalesce(F.nullif(human, F.lit("")), "quality_hint").alias("quality"),
        "chars", (F.col("chars") > 0).alias("has_text"), "reviewed",
    )


@query(f"WITH {_REVIEW}, {_INDEX} SELECT * FROM idx")
def search_index(spark, sf_dir):
    return _index(spark, sf_dir)


@query(f"""WITH {_REVIEW}, {_INDEX} SELECT batch, count(*) AS n, count(*) = count(DISTINCT doc_id) AS unique_ids, bool_and(source IS NOT NULL) AS all_sources, bool_and(has_text = (chars > 0)) AS text_matches, count(*) FILTER (has_text) AS with_text, sum(chars)::BIGINT AS chars FROM idx GROUP BY batch""")
def index_evidence(spark, sf_dir):
    return _index(spark, sf_dir).groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) == F.count_distinct("doc_id")).alias("unique_ids"), F.bool_and(F.col("source").isNotNull()).alias("all_sources"),
        F.bool_and(F.col("has_text") == (F.col("chars") > 0)).alias("text_matches"), F.count_if("has_text").alias("with_text"), F.sum("chars").alias("chars"),
    )


@query("SELECT conv_id, string_agg(turn || ':' || role, ',' ORDER BY turn) AS turns, count(*) AS n, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY conv_id")
def memberships_nested(spark, sf_dir):
    items = F.sort_array(F.collect_list(F.struct("turn", "role")))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(items.alias("x"), F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))
    return rows.select("conv_id", F.array_join(F.transform("x", lambda t: F.concat_ws(":", t["turn"].cast("string"), t["role"])), ",").alias("turns"), "n", "chars")


@query("SELECT event_id, coalesce(json_extract_string(props, '$.k')::BIGINT, -1) AS k, coalesce(json_extract_string(props, '$.missing'), 'none') AS missing FROM events")
def json_path_default(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.coalesce(F.get_json_object("props", "$.k").cast("bigint"), F.lit(-1).cast("bigint")).alias("k"), F.coalesce(F.get_json_object("props", "$.missing"), F.lit("none")).alias("missing")
    )


@query("""WITH before AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice AS p FROM orders WHERE o_orderdate < '2000-01-01'),
after AS (SELECT o_orderkey AS k, CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS s, o_totalprice AS p FROM orders WHERE o_orderdate >= '1996-01-01')
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'added' WHEN a.k IS NULL THEN 'removed' ELSE 'modified' END AS change FROM before b FULL JOIN after a ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.s IS DISTINCT FROM b.s OR a.p IS DISTINCT FROM b.p""")
def snapshot_delta(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    changed = F.when(F.col("o_orderpriority") == "1-URGENT", "X").otherwise(F.col("o_orderstatus"))
    before = rows.where("o_orderdate < '2000-01-01'").select(F.col("o_orderkey").alias("k"), F.struct(F.col("o_orderstatus").alias("s"), "o_totalprice").alias("b"))
    after = rows.where("o_orderdate >= '1996-01-01'").select(F.col("o_orderkey").alias("k"), F.struct(changed.alias("s"), "o_totalprice").alias("a"))
    change = F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed").otherwise("modified")
    return before.join(after, "k", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("k", change.alias("change"))


def _titles(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(F.lower("p_name").alias("title")).agg(F.count(F.lit(1)).alias("n"))


def _grams(column, width=3):
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(column) - width + 1)), lambda i: F.substring(column, i, F.lit(width))))


@query("""WITH t AS (SELECT lower(p_name) AS title, count(*) AS n FROM part GROUP BY 1), w AS (SELECT DISTINCT unnest(string_split(title, ' ')) AS word FROM t)
SELECT word, title, n FROM w JOIN t ON contains(title, word)""")
def title_theta(spark, sf_dir):
    """Titles that contain a word anywhere: joined on the word's first three characters, then checked."""
    titles = _titles(spark, sf_dir)
    words = titles.select(F.explode(F.split("title", " ")).alias("word")).distinct().withColumn("g", F.substring("word", 1, 3))
    grams = titles.withColumn("g", F.explode(F.array_distinct(F.flatten(F.array(*(_grams(F.col("title"), k) for k in (1, 2, 3)))))))
    return words.join(grams, "g").where(F.contains("title", "word")).select("word", "title", "n").distinct()


@query()
def title_fuzzy_top3(spark, sf_dir):
    """For each title the three others most like it, at a ratio of 0.9 or more."""
    return fuzzy_top3(_titles(spark, sf_dir))


def fuzzy_top3(titles):
    """title, other, score, k: the three most alike ``titles`` at 0.9 or more; such titles share three characters in a row, and the
    shorter one alone bounds what can match."""
    titles = titles.select("title", F.explode(_grams(F.col("title"))).alias("g"))
    a, b = titles.alias("a"), titles.alias("b")
    near = (F.col("a.g") == F.col("b.g")) & (F.col("a.title") != F.col("b.title")) & (2 * F.least(F.length("a.title"), F.length("b.title")) >= 0.9 * (F.length("a.title") + F.length("b.title")))
    pairs = a.join(b, near).select(F.col("a.title").alias("title"), F.col("b.title").alias("other")).distinct()

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([difflib.SequenceMatcher(None, p, q).ratio() for p, q in zip(x, y)])

    scored = pairs.withColumn("score", ratio("title", "other")).where("score >= 0.9")
    k = F.row_number().over(Window.partitionBy("title").orderBy(F.desc("score"), F.desc("other")))
    return scored.withColumn("k", k).where("k <= 3")


@query("""WITH kept AS (SELECT doc_id FROM documents WHERE length(text) >= 500), gone AS (SELECT doc_id FROM documents WHERE length(text) < 500)
SELECT (SELECT count(*) FROM (SELECT * FROM kept INTERSECT SELECT * FROM gone)) AS shared, (SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT (SELECT * FROM kept UNION SELECT * FROM gone))) AS missing,
(SELECT count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT * FROM kept)) AS labelled_gone""")
def setops_partition(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("n"))
    kept, gone = docs.where("n >= 500").select("doc_id"), docs.where("n < 500").select("doc_id")
    checks = (("shared", kept.intersect(gone)), ("missing", docs.select("doc_id").subtract(kept.union(gone))), ("labelled_gone", table(spark, sf_dir, "labels").select("doc_id").subtract(kept)))
    counts = [rows.agg(F.count(F.lit(1)).alias(name)) for name, rows in checks]
    return counts[0].join(counts[1], how="cross").join(counts[2], how="cross")  # one row each


@query("SELECT DISTINCT o_orderpriority AS value FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')")
def validate_vocab(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")).select(F.col("o_orderpriority").alias("value")).distinct()


@query("""SELECT 'unique_ids' AS rule, count(*) - count(DISTINCT doc_id) AS violations FROM documents UNION ALL SELECT 'has_text', count(*) FILTER (coalesce(text, '') = '') FROM documents
UNION ALL SELECT 'length', count(*) FILTER (n_chars IS DISTINCT FROM length(text)) FROM documents UNION ALL SELECT 'labels_known', (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))
UNION ALL SELECT 'vocabulary', (SELECT count(*) FROM labels WHERE quality NOT IN (0, 1) OR toxic NOT IN (0, 1))""")
def validation_report(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    one = docs.agg(
        (F.count(F.lit(1)) - F.count_distinct("doc_id")).alias("unique_ids"), F.count_if(F.coalesce("text", F.lit("")) == "").alias("has_text"), F.count_if(~F.col("n_chars").eqNullSafe(F.length("text").cast("bigint"))).alias("length"),
    ).select(F.explode(F.array(*(F.struct(F.lit(c).alias("rule"), F.col(c).alias("violations")) for c in ("unique_ids", "has_text", "length")))).alias("x")).select("x.*")
    known = labels.join(docs, "doc_id", "left_anti").agg(F.count(F.lit(1)).alias("violations")).select(F.lit("labels_known").alias("rule"), "violations")
    vocabulary = labels.agg(F.count_if(~F.col("quality").isin(0, 1) | ~F.col("toxic").isin(0, 1)).alias("violations")).select(F.lit("vocabulary").alias("rule"), "violations")
    return one.union(known).union(vocabulary)


@query("""WITH RECURSIVE e AS (SELECT 'c' || c_custkey AS a, 'n' || c_nationkey AS b FROM customer UNION SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation),
up AS (SELECT a, b, 1 AS depth FROM e UNION SELECT up.a, e.b, depth + 1 FROM up JOIN e ON e.a = up.b WHERE depth < 20)
SELECT a, count(*) AS ancestors, max(depth)::INT AS depth, bool_or(a = b) AS cyclic FROM (SELECT a, b, min(depth) AS depth FROM up GROUP BY a, b) GROUP BY a""")
def lineage_acyclic(spark, sf_dir):
    """Ancestors of every node of a lineage graph, level by level; a node that is its own ancestor is on a cycle."""
    edges = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("a"), F.concat(F.lit("n"), "c_nationkey").alias("b"))
    edges = materialised(edges.union(table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey"), F.concat(F.lit("r"), "n_regionkey"))).distinct())
    return ancestors(edges)


def ancestors(edges):
    """a, ancestors, depth (of the farthest one, by its shortest path), cyclic for every node ``a`` of ``edges`` (a, b), to a fixpoint."""
    seen = level = edges.withColumn("depth", F.lit(1))
    depth = 1
    while not level.isEmpty():
        depth += 1
        ahead = level.select("a", F.col("b").alias("m")).join(edges.select(F.col("a").alias("m"), "b"), "m")
        level = materialised(ahead.select("a", "b", F.lit(depth).alias("depth")).distinct().join(seen.select("a", "b"), ["a", "b"], "left_anti"))
        seen = seen.unionByName(level)
    return seen.groupBy("a").agg(F.count_distinct("b").alias("ancestors"), F.max("depth").alias("depth"), F.bool_or(F.col("a") == F.col("b")).alias("cyclic"))


@query("SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey")
def strict_inner(spark, sf_dir):
    return (
        table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey")).select("c_custkey", "n_name", "r_name")
    )


@query("SELECT o_custkey AS k, arg_max(o_orderkey, o_orderkey) AS last_key, arg_max(o_orderstatus, o_orderkey) AS last_status, count(DISTINCT o_orderstatus) > 1 AS conflict FROM orders GROUP BY 1")
def last_wins_conflicts(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(
        F.max("o_orderkey").alias("last_key"), F.max_by("o_orderstatus", "o_orderkey").alias("last_status"), (F.count_distinct("o_orderstatus") > 1).alias("conflict")
    )


@query("SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 100)::BIGINT AS batch FROM documents")
def batches_of_100(spark, sf_dir):
    done = numbered(table(spark, sf_dir, "documents").select("doc_id"), F.col("doc_id"), name="n")
    return done.select("doc_id", F.floor((F.col("n") - 1) / 100).alias("batch"))


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS qty, sum(l_extendedprice * (1 - l_discount)) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= '1998-09-02' GROUP BY 1, 2")
def volume_sums(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where("l_shipdate <= '1998-09-02'").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("qty"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"), F.count(F.lit(1)).alias("n")
    )
