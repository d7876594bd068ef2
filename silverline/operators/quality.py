"""Declarative data-quality rules (Q1-Q13).

A rule is a lazily built DataFrame of *violating rows*: empty means pass.
`run_checks` turns a list of rules into one report DataFrame
(rule, severity, failures, status), evaluated in as few passes as possible:
row-level rules over the same frame are fused into a single aggregation
(`count_if` per rule), `unique` rules over the same frame share one
grouping-sets aggregation, and only custom set-level rules contribute an
aggregate each. Joins a check needs are done once, in a "checked" frame
whose predicates then fuse like any row-level rule. Nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    source: DataFrame
    # Row-level rules: predicate that is TRUE for a violating row.
    predicate: Column | None = None
    # Set-level rules (unique, relationships, custom SQL): builds violations.
    build: Callable[[], DataFrame] | None = None
    key: str | None = None
    severity: str = "error"  # "error" | "warn"
    columns: Sequence[str] = field(default_factory=tuple)
    kind: str = "predicate"  # "predicate" | "unique" | "custom"

    def violations(self) -> DataFrame:
        if self.build is not None:
            return self.build()
        return self.source.filter(self.predicate)

    def violation_keys(self) -> DataFrame:
        """Long form (rule, record_key) for reports and stored failures."""
        v = self.violations()
        return v.select(F.lit(self.name).alias("rule"), F.col(self.key).cast("string").alias("record_key"))


def not_null(df: DataFrame, column: str, key: str, name: str | None = None, severity="error") -> Rule:
    """Q1."""
    return Rule(name or f"not_null_{column}", df, predicate=F.col(column).isNull(), key=key,
                severity=severity, columns=(column,))


def accepted_values(df: DataFrame, column: str, values: Sequence, key: str, name: str | None = None,
                    severity="error") -> Rule:
    """Q3: NULL passes (three-valued NOT IN), like the SQL tests."""
    pred = ~F.col(column).isin(*values)
    return Rule(name or f"accepted_values_{column}", df, predicate=F.coalesce(pred, F.lit(False)), key=key,
                severity=severity, columns=(column,))


def expression(df: DataFrame, name: str, failing: Column, key: str, severity="error", columns: Sequence[str] = ()) -> Rule:
    """Q5/Q6/Q12: any row-level predicate (NULLs count as they evaluate). With
    `columns`, all that it reads, it can ride on the write of a frame that has them."""
    return Rule(name, df, predicate=F.coalesce(failing, F.lit(False)), key=key, severity=severity, columns=tuple(columns))


def unique(df: DataFrame, column: str, name: str | None = None, severity="error") -> Rule:
    """Q2: non-null values seen more than once. One row per duplicated value
    (a partial + final aggregate; a hot value is pre-counted per task)."""

    def build():
        return (df.filter(F.col(column).isNotNull()).groupBy(column)
                .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))

    return Rule(name or f"unique_{column}", df, build=build, key=column, severity=severity, columns=(column,),
                kind="unique")


def relationships(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str, key: str,
                  name: str | None = None, severity="error") -> Rule:
    """Q4: child value must exist in the parent; NULL children are ignored.
    left_anti join; the parent side is reduced to distinct keys first."""

    def build():
        parents = parent.select(F.col(parent_col).alias("_pk")).distinct()
        c = child.filter(F.col(child_col).isNotNull())
        return c.join(parents, c[child_col] == parents["_pk"], "left_anti")

    return Rule(name or f"relationships_{child_col}", child, build=build, key=key, severity=severity,
                columns=(child_col,), kind="custom")


def custom(df: DataFrame, name: str, build: Callable[[], DataFrame], key: str, severity="error") -> Rule:
    """Singular SQL-style test: any DataFrame of violating rows."""
    return Rule(name, df, build=build, key=key, severity=severity, kind="custom")


def _status(failures: Column, severity: Column) -> Column:
    return (F.when(failures == 0, F.lit("PASS"))
            .when(severity == F.lit("warn"), F.lit("WARN"))
            .otherwise(F.lit("ERROR")))


def _stacked(wide: DataFrame, group: Sequence[Rule]) -> DataFrame:
    stack = ", ".join(f"'{r.name}', '{r.severity}', CAST(c{i} AS BIGINT)" for i, r in enumerate(group))
    return wide.selectExpr(f"stack({len(group)}, {stack}) AS (rule, severity, failures)")


def _unique_counts(src: DataFrame, group: Sequence[Rule]) -> DataFrame:
    """All `unique` rules of one frame in a single aggregation: one grouping
    set per column (Expand + one shuffle), then duplicated non-null values
    counted per set."""
    cols = [r.columns[0] for r in group]
    per_value = src.groupingSets([[F.col(c)] for c in cols], *[F.col(c) for c in cols]).agg(
        F.count(F.lit(1)).alias("_n"), *[F.grouping(c).alias(f"_g{i}") for i, c in enumerate(cols)])
    wide = per_value.agg(*[
        F.count_if((F.col(f"_g{i}") == 0) & F.col(c).isNotNull() & (F.col("_n") > 1)).alias(f"c{i}")
        for i, c in enumerate(cols)])
    return _stacked(wide, group)


def run_checks(rules: Sequence[Rule]) -> DataFrame:
    """Q11: report (rule, severity, failures, status) for all rules.

    Row-level rules sharing a source frame are evaluated in one aggregation
    pass and `unique` rules sharing a frame in one grouping-sets pass; only
    custom set-level rules get a pass of their own. The result is tiny (one
    row per rule) and fully lazy."""
    parts: list[DataFrame] = []
    fused: dict[int, list[Rule]] = {}
    uniques: dict[int, list[Rule]] = {}
    for r in rules:
        if r.predicate is not None:
            fused.setdefault(id(r.source), []).append(r)
        elif r.kind == "unique":
            uniques.setdefault(id(r.source), []).append(r)
        else:
            parts.append(r.violations().agg(
                F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"),
                F.count(F.lit(1)).alias("failures")))
    for group in fused.values():
        wide = group[0].source.agg(*[F.count_if(r.predicate).alias(f"c{i}") for i, r in enumerate(group)])
        parts.append(_stacked(wide, group))
    for group in uniques.values():
        parts.append(_unique_counts(group[0].source, group))
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    return report.withColumn("status", _status(F.col("failures"), F.col("severity")))


def observable(rules: Sequence[Rule], df: DataFrame) -> list[Rule]:
    """The row-level rules on the rows of `df` (joined to others or not) that read its own columns only."""
    own = set(df.columns)
    return [r for r in rules if r.predicate is not None and r.columns and set(r.columns) <= own <= set(r.source.columns)]


def write_observed(df: DataFrame, path: str, rules: Sequence[Rule]) -> tuple[DataFrame, dict[str, int]]:
    """Stores `df` and evaluates row-level rules on the rows as they are written:
    (the stored table, violations by rule name). The counts are metrics of the
    write's own tasks, which count once however often a task is run, so the
    rules cost no scan. Where the optimizer leaves no rows to observe, they are
    counted on the stored table."""
    spark = df.sparkSession
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(r.predicate).alias(f"c{i}") for i, r in enumerate(rules)]) \
        .write.mode("overwrite").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    found = seen.get
    if "rows" not in found:
        found = table.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(r.predicate).alias(f"c{i}") for i, r in enumerate(rules)]).first().asDict()
    return table, {r.name: int(found[f"c{i}"]) for i, r in enumerate(rules)}


def report_of(spark: SparkSession, rules: Sequence[Rule], counted: dict[str, int]) -> DataFrame:
    """The report of `run_checks` where `counted` holds the violations of some rules already."""
    known = [(r.name, r.severity, counted[r.name]) for r in rules if r.name in counted]
    report = spark.createDataFrame(known, "rule string, severity string, failures bigint")
    report = report.withColumn("status", _status(F.col("failures"), F.col("severity")))
    rest = [r for r in rules if r.name not in counted]
    return report.unionByName(run_checks(rest)) if rest else report


def violations_long(rules: Sequence[Rule]) -> DataFrame:
    """All violating rows of `rules` as (rule, record_key). Row-level rules of
    one frame are evaluated in one pass over it: every row yields the names of
    the rules it fails. Set-level rules contribute a pass each."""
    parts: list[DataFrame] = []
    fused: dict[int, list[Rule]] = {}
    for r in rules:
        if r.predicate is not None:
            fused.setdefault(id(r.source), []).append(r)
        else:
            parts.append(r.violation_keys())
    for group in fused.values():
        failed = F.array(*[F.when(r.predicate, F.struct(F.lit(r.name).alias("rule"), F.col(r.key).cast("string").alias("record_key")))
                           for r in group])
        parts.append(group[0].source.select(F.explode(F.filter(failed, lambda x: x.isNotNull())).alias("f")).select("f.rule", "f.record_key"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def store_failures(rules: Sequence[Rule], audit_path: str) -> None:
    """dbt's store_failures: write every rule's violating rows under
    `audit_path/rule=<name>/` in one job (partitioned write of the long form)."""
    violations_long(rules).write.mode("overwrite").partitionBy("rule").parquet(audit_path)


# ---------------------------------------------------------------- failures by run

AUDIT = "rule string, run string, record_key string, record string"


def violations_with_rows(rules: Sequence[Rule]) -> DataFrame:
    """All violating rows of `rules` as (rule, record_key, record): the record is
    the row as JSON, nulls included. Row-level rules of one frame share a pass."""
    def told(df: DataFrame) -> Column:
        return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})

    parts: list[DataFrame] = []
    fused: dict[int, list[Rule]] = {}
    for r in rules:
        if r.predicate is not None:
            fused.setdefault(id(r.source), []).append(r)
        else:
            v = r.violations()
            parts.append(v.select(F.lit(r.name).alias("rule"), F.col(r.key).cast("string").alias("record_key"), told(v).alias("record")))
    for group in fused.values():
        source = group[0].source
        failed = F.filter(F.array(*[F.when(r.predicate, F.struct(F.lit(r.name).alias("rule"), F.col(r.key).cast("string").alias("record_key")))
                                    for r in group]), lambda x: x.isNotNull())
        rows = source.select(failed.alias("_failed"), told(source).alias("record")).where(F.size("_failed") > 0)
        parts.append(rows.select("record", F.explode("_failed").alias("f")).select("f.rule", "f.record_key", "record"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def store_failures_of_run(rules: Sequence[Rule], audit_path: str, run: str) -> None:
    """Adds the failures of one run to an audit table partitioned by (rule, run).

    Partitions are overwritten dynamically: a repeated run replaces its own
    partitions of the rules it checked and no others. Every rule writes a marker
    without a record, so that one which fails no more leaves an empty partition
    and not its earlier rows, and a rule that passed is told from one not run."""
    found = violations_with_rows(rules)
    spark = found.sparkSession
    markers = spark.createDataFrame([(r.name, None, None) for r in rules], found.schema)
    (found.unionByName(markers).select("rule", F.lit(run).alias("run"), "record_key", "record")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("rule", "run").parquet(audit_path))


def read_failures(spark: SparkSession, audit_path: str) -> DataFrame:
    """rule, run, record_key, record of the stored failures of all runs; rule and run prune partitions."""
    return _audit(spark, audit_path).where("record IS NOT NULL").select("rule", "run", "record_key", "record")


def failures_by_run(spark: SparkSession, audit_path: str) -> DataFrame:
    """rule, run, failures of every rule of every run, those that passed included."""
    return _audit(spark, audit_path).groupBy("rule", "run").agg(F.count("record").alias("failures"))


def _audit(spark: SparkSession, audit_path: str) -> DataFrame:
    return spark.read.schema(AUDIT).parquet(audit_path)
