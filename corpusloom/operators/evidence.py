"""Rules about tables of evidence: checked together, reported with severity, count and examples.

All rules on rows or totals of one table are aggregates of a single scan. Rules between tables
are joins of keys. The report is a table; nothing fails before ``passed`` is asked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as X

ERROR, WARNING = "error", "warning"
#: Keys that a report names for a rule between tables; of a rule on rows it names the least.
EXAMPLES = 3
REPORT = ["check", "severity", "violations", "examples"]


@dataclass(frozen=True)
class Holds:
    """Every row of ``table`` meets ``condition``; null doesn't. ``key`` names rows in examples."""

    check: str
    table: str
    condition: Column
    key: str
    severity: str = ERROR


@dataclass(frozen=True)
class Total:
    """An aggregate of ``table`` has the ``expected`` value; the violations are 1 or 0."""

    check: str
    table: str
    value: Column
    expected: int
    severity: str = ERROR


@dataclass(frozen=True)
class Unique:
    """No value of ``key`` repeats; nulls aren't compared. Violations: values that do."""

    check: str
    table: str
    key: Column
    severity: str = ERROR


@dataclass(frozen=True)
class Within:
    """Every value of ``key`` (or of the arrays ``key``, if ``each``) is a value of ``other_key`` in ``other``. Nulls aren't looked for."""

    check: str
    table: str
    key: Column
    other: str
    other_key: Column
    severity: str = ERROR
    each: bool = False


@dataclass(frozen=True)
class Agrees:
    """Rows of ``table`` and ``other`` with equal keys hold equal values, null equal to null. Rows without a partner are ``Within``'s matter."""

    check: str
    table: str
    key: Column
    value: Column
    other: str
    other_key: Column
    other_value: Column
    severity: str = ERROR


Rule = Holds | Total | Unique | Within | Agrees


def _line(rule: Rule, violations: Column, examples: Column, waived: frozenset[str]) -> Column:
    severity = WARNING if rule.check in waived else rule.severity
    return F.struct(F.lit(rule.check).alias("check"), F.lit(severity).alias("severity"), F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"), examples.cast("array<string>").alias("examples"))


def _scanned(rows: DataFrame, rules: list[Holds | Total], waived: frozenset[str]) -> DataFrame:
    """One line for each rule, from one pass over ``rows``."""
    values: list[Column] = []
    for k, rule in enumerate(rules):
        if isinstance(rule, Total):
            values += [(~rule.value.eqNullSafe(F.lit(rule.expected))).cast("int").alias(f"n{k}"), F.coalesce(rule.value.cast("string"), F.lit("null")).alias(f"e{k}")]
        else:
            broken = ~F.coalesce(rule.condition, F.lit(False))
            values += [F.count_if(broken).alias(f"n{k}"), F.min(F.when(broken, F.coalesce(F.col(rule.key).cast("string"), F.lit("null")))).alias(f"e{k}")]
    lines = [_line(rule, F.col(f"n{k}"), F.when(F.col(f"n{k}") > 0, F.array(f"e{k}")).otherwise(F.array()), waived) for k, rule in enumerate(rules)]
    return rows.agg(*values).select(F.explode(F.array(*lines)).alias("x")).select("x.*")


def _found(keys: DataFrame, rule: Rule, waived: frozenset[str]) -> DataFrame:
    """The line of a rule whose violations are ``keys`` (k); the least of them are kept while counting."""
    text = F.col("k").cast("string")
    least = keys.select(text.alias("k")).orderBy("k").limit(EXAMPLES).agg(F.sort_array(F.collect_list("k")).alias("e"))
    counted = keys.agg(F.count(F.lit(1)).alias("n"))
    return counted.join(least, how="cross").select(_line(rule, F.col("n"), F.col("e"), waived).alias("x")).select("x.*")  # one row each


def _between(rule: Unique | Within | Agrees, tables: dict[str, DataFrame]) -> DataFrame:
    rows = tables[rule.table]
    match rule:
        case Unique():
            return rows.select(rule.key.alias("k")).where("k is not null").groupBy("k").count().where("count > 1").select("k")
        case Within():
            keys = rows.select((F.explode(rule.key) if rule.each else rule.key).alias("k")).where("k is not null").distinct()
            return keys.join(tables[rule.other].select(rule.other_key.alias("k")), "k", "left_anti")
        case Agrees():
            left = rows.select(rule.key.alias("k"), rule.value.alias("a"))
            right = tables[rule.other].select(rule.other_key.alias("k"), rule.other_value.alias("b"))
            return left.join(right, "k").where(~F.col("a").eqNullSafe(F.col("b"))).select("k").distinct()
    raise TypeError(f"{rule} is no rule")


def report(tables: dict[str, DataFrame], rules: Iterable[Rule], waived: Iterable[str] = ()) -> DataFrame:
    """check, severity, violations, examples: a line for each rule; errors of ``waived`` checks count as warnings.

    Tables are scanned once for all rules on their rows and totals. Empty tables meet all rules but
    totals. Checks must have different names.
    """
    rules, waived = list(rules), frozenset(waived)
    if len({r.check for r in rules}) < len(rules):
        raise ValueError("two rules have one name")
    parts = []
    for name in dict.fromkeys(r.table for r in rules):
        own = [r for r in rules if r.table == name]
        if scans := [r for r in own if isinstance(r, Holds | Total)]:
            parts.append(_scanned(tables[name], scans, waived))
        parts += [_found(_between(r, tables), r, waived) for r in own if not isinstance(r, Holds | Total)]
    return reduce(DataFrame.unionByName, parts).select(*REPORT)


def passed(lines: DataFrame) -> bool:
    """Whether a report has no violated rule of severity error."""
    return lines.where((F.col("severity") == ERROR) & (F.col("violations") > 0)).isEmpty()


def vocabulary(table: str, key: str, allowed: dict[str, Iterable[str]]) -> list[Rule]:
    """Fields with controlled values."""
    return [Holds(f"{field} is controlled", table, F.col(field).isin(*values), key) for field, values in allowed.items()]


def manifest_rules(rows: int, allowed: dict[str, Iterable[str]] = {}) -> list[Rule]:  # noqa: B006
    """Tables manifest (queue_id, object_id, url, sha256, bytes), annotations (queue_id, document_url, artifact_sha256,
    fetch_status, reviewer) and files (queue_id, sha256, bytes). The check "artifact digest is unique" can be waived."""
    q, sha = F.col("queue_id"), F.col("sha256")
    return [
        Total("manifest rows", "manifest", F.count(F.lit(1)), rows),
        Total("annotation rows", "annotations", F.count(F.lit(1)), rows),
        Unique("queue_id is unique", "annotations", q),
        Unique("object id is unique", "manifest", F.col("object_id")),
        Unique("source URL is unique", "manifest", F.col("url")),
        Unique("artifact digest is unique", "manifest", sha),
        Within("artifact is there", "manifest", q, "files", q),
        Agrees("artifact has its digest", "manifest", q, sha, "files", q, sha),
        Agrees("artifact has its size", "manifest", q, F.col("bytes"), "files", q, F.col("bytes")),
        Within("manifest row is annotated", "manifest", q, "annotations", q),
        Agrees("annotation has the digest", "manifest", q, sha, "annotations", q, F.col("artifact_sha256")),
        Agrees("annotation has the URL", "manifest", q, F.col("url"), "annotations", q, F.col("document_url")),
        Within("annotated digest is in the manifest", "annotations", F.col("artifact_sha256"), "manifest", sha),
        *vocabulary("annotations", "queue_id", allowed),
        Holds("file was downloaded", "annotations", F.col("fetch_status") == "downloaded", "queue_id"),
        Total("no review is completed", "annotations", (F.count_if(F.trim("reviewer") != "") == 0).cast("int"), 0, WARNING),
    ]


def extraction_rules(rows: int, allowed: dict[str, Iterable[str]] = {}) -> list[Rule]:  # noqa: B006
    """Tables sources (object_id), extractions (queue_id, source_object_id, sha256, bytes, path), texts (queue_id, sha256, bytes)
    and observations (queue_id, text_sha256, text_path, extract_status, machine_extraction_quality_hint, machine_pii_hint)."""
    q, sha = F.col("queue_id"), F.col("sha256")
    return [
        *(Total(f"{name} rows", name, F.count(F.lit(1)), rows) for name in ("sources", "extractions", "observations")),
        Within("extracted object is a source", "extractions", F.col("source_object_id"), "sources", F.col("object_id")),
        Within("source is extracted", "sources", F.col("object_id"), "extractions", F.col("source_object_id")),
        Unique("observation is unique", "observations", q),
        Within("text is there", "extractions", q, "texts", q),
        Agrees("text has its digest", "extractions", q, sha, "texts", q, sha),
        Agrees("text has its size", "extractions", q, F.col("bytes"), "texts", q, F.col("bytes")),
        Within("extraction is observed", "extractions", q, "observations", q),
        Agrees("observation has the digest", "extractions", q, sha, "observations", q, F.col("text_sha256")),
        Agrees("observation has the path", "extractions", q, F.col("path"), "observations", q, F.col("text_path")),
        *vocabulary("observations", "queue_id", allowed),
        Holds("text isn't empty", "observations", F.col("extract_status") != "empty_text", "queue_id", WARNING),
        Holds("quality suffices", "observations", ~F.col("machine_extraction_quality_hint").isin("poor", "not_extractable"), "queue_id", WARNING),
        Holds("no personal data is hinted at", "observations", F.col("machine_pii_hint") != "yes", "queue_id", WARNING),
    ]


def dataset_rules(kept: int, inputs: int, tokens: int, license: str, sample: int = 12) -> list[Rule]:
    """Tables rows (id, text, token_count, license, author), attribution (id), decisions (id, selected) and sample (id, text)."""
    i = F.col("id")
    return [
        Total("kept rows", "rows", F.count(F.lit(1)), kept),
        Total("attributed rows", "attribution", F.count(F.lit(1)), kept),
        Total("decisions", "decisions", F.count(F.lit(1)), inputs),
        Total("selected decisions", "decisions", F.count_if("selected"), kept),
        Total("tokens", "rows", F.coalesce(F.sum("token_count"), F.lit(0)), tokens),
        Total("sampled rows", "sample", F.count(F.lit(1)), min(sample, kept)),
        Unique("id is unique", "rows", i),
        Unique("attribution is unique", "attribution", i),
        Within("row is attributed", "rows", i, "attribution", i),
        Within("attribution has a row", "attribution", i, "rows", i),
        Within("row was selected", "rows", i, "decisions", F.when(F.col("selected"), i)),
        Holds("author is named", "rows", F.col("author") != "", "id"),
        Holds("license is the set's", "rows", F.col("license") == license, "id"),
        Holds("no replacement characters", "rows", ~F.contains("text", F.lit("�")), "id"),
        Holds("no e-mail address", "rows", ~F.col("text").rlike(X.EMAIL), "id"),
        Within("sampled row is there", "sample", i, "rows", i),
        Agrees("sampled row is the same", "sample", i, F.col("text"), "rows", i, F.col("text")),
    ]


def lineage_rules(predicates: Iterable[str] = ()) -> list[Rule]:
    """Tables claims (id, supported_by, falsification_condition), evidence (id), runs (id, success) and relations (source, predicate, target)."""
    return [
        Holds("claim can be falsified", "claims", F.trim("falsification_condition") != "", "id"),
        Within("support is evidence", "claims", F.col("supported_by"), "evidence", F.col("id"), each=True),
        Holds("claim is supported", "claims", F.size("supported_by") > 0, "id"),
        Unique("evidence is unique", "evidence", F.col("id")),
        Total("two runs or more", "runs", (F.count_if("success") >= 2).cast("int"), 1),
        Holds("run succeeded", "runs", F.col("success"), "id"),
        *(Total(f"a relation {p}", "relations", (F.count_if(F.col("predicate") == p) > 0).cast("int"), 1) for p in predicates),
    ]


@dataclass(frozen=True)
class Transform:
    """A recorded step from a snapshot's rows to result rows; a change of what it gives is a new version."""

    name: str
    version: str
    make: Callable[[DataFrame], DataFrame]


def replayed(snapshot: DataFrame, recorded: DataFrame, key: str, transform: Transform, version: Column | None = None) -> DataFrame:
    """key, problem, columns: rows of ``recorded`` that the ``transform`` of ``snapshot`` doesn't give again.

    The problems: another version of the transform is recorded (column ``version``), the row is
    missing in the replay or in the record, or columns differ, null equal to null; ``columns``
    names these. All columns that the transform gives are compared; keys are unique.
    """
    made = transform.make(snapshot)
    values = [c for c in made.columns if c != key]
    lacking = [c for c in values if c not in recorded.columns]
    if lacking:
        raise ValueError(f"not recorded: {', '.join(lacking)}")
    old = recorded.select(F.col(key).alias("_k"), F.struct(*values).alias("_old"), (version if version is not None else F.lit(transform.version)).alias("_version"))
    both = old.join(made.select(F.col(key).alias("_key"), F.struct(*values).alias("_new")), F.col("_k").eqNullSafe(F.col("_key")), "full")
    differ = F.array_compact(F.array(*(F.when(~F.col("_old")[c].eqNullSafe(F.col("_new")[c]), F.lit(c)) for c in values)))
    problem = (
        F.when(F.col("_old").isNull(), "not recorded").when(F.col("_new").isNull(), "not replayed")
        .when(~F.col("_version").eqNullSafe(F.lit(transform.version)), "other version").when(F.size(differ) > 0, "differs")
    )
    paired = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    lines = both.select(F.coalesce("_k", "_key").alias(key), problem.alias("problem"), F.when(paired, differ).otherwise(F.array().cast("array<string>")).alias("columns"))
    return lines.where("problem is not null")
