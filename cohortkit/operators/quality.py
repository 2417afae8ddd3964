"""Declarative data-quality checks.

Each check yields a row ``(check_id, model, column_name, check_name, failing_rows,
passed)``.  All row-level checks of one model (not_null, between, row_count) are fused
into a single aggregate over the model, i.e. one scan.  All ``unique`` and
``accepted_values`` checks of all models share one exchange: each model is scanned once
more, a row gives (check, 128-bit hash of the value) for each unique column and for each
value that is off its list, and these are counted (partial aggregation first; of accepted
values none normally gets there).  Two different values of 10^10 share a hash with a
probability below 10^-18.
Column-order checks read only the schema.

Semantics (nulls pass unless stated):
  not_null         rows where the column is null
  unique           distinct non-null values that occur more than once
  accepted_values  distinct non-null values outside the list
  between          rows whose value is outside [lo, hi] (inclusive; None: no bound)
  row_count        1 when the table's row count is outside [lo, hi], else 0
  columns          1 when the ordered column list differs from the expected one, else 0
  relationships    rows whose non-null value has no match in ``ref_model.ref_column``
                   (one anti join against the parent's distinct keys)
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..schemas import STG_REVIEWS_COLUMNS


@dataclass(frozen=True)
class Check:
    model: str
    kind: str
    column: str | None = None
    values: tuple | None = None
    lo: object = None
    hi: object = None
    ref_model: str | None = None
    ref_column: str | None = None

    @property
    def check_id(self) -> str:
        return f"{self.model}.{self.column or '_table'}.{self.kind}"


# The declared check suite on the staging models (35 checks).  The bounds of the row counts
# and of the review date depend on the deployment; they come from the parameters (``suite``).
SUITE: list[Check] = [
    Check("stg_launches", "not_null", "id"),
    Check("stg_launches", "unique", "id"),
    Check("stg_launches", "not_null", "name"),
    Check("stg_launches", "not_null", "product_url"),
    Check("stg_launches", "unique", "product_url"),
    Check("stg_launches", "not_null", "upvotes"),
    Check("stg_launches", "not_null", "traction_tier"),
    Check("stg_launches", "accepted_values", "traction_tier",
          values=("High Traction", "Medium Traction", "Low Traction")),
    Check("stg_launches", "not_null", "category"),
    Check("stg_reviews", "row_count", lo=0),
    Check("stg_reviews", "columns", values=tuple(STG_REVIEWS_COLUMNS)),
    Check("stg_reviews", "not_null", "review_id"),
    Check("stg_reviews", "unique", "review_id"),
    Check("stg_reviews", "not_null", "user_id"),
    Check("stg_reviews", "not_null", "business_id"),
    Check("stg_reviews", "not_null", "stars"),
    Check("stg_reviews", "between", "stars", lo=1, hi=5),
    Check("stg_reviews", "not_null", "review_date"),
    Check("stg_reviews", "between", "review_date"),
    Check("stg_reviews", "not_null", "review_month"),
    Check("stg_reviews", "not_null", "engagement_score"),
    Check("stg_reviews", "between", "engagement_score", lo=0, hi=1000),
    Check("stg_reviews", "not_null", "sentiment"),
    Check("stg_reviews", "accepted_values", "sentiment", values=tuple(P.SENTIMENTS)),
    Check("stg_users", "row_count", lo=0),
    Check("stg_users", "not_null", "user_id"),
    Check("stg_users", "unique", "user_id"),
    Check("stg_users", "not_null", "cohort_month"),
    Check("stg_users", "not_null", "review_count"),
    Check("stg_users", "between", "review_count", lo=0, hi=100_000),
    Check("stg_users", "between", "average_stars", lo=1, hi=5),
    Check("stg_users", "not_null", "user_segment"),
    Check("stg_users", "accepted_values", "user_segment",
          values=tuple(P.SEGMENT_NAMES)),
    Check("stg_users", "not_null", "influence_tier"),
    Check("stg_users", "accepted_values", "influence_tier", values=tuple(P.INFLUENCE_NAMES)),
]


def suite(params: P.Params) -> list[Check]:
    """The suite with the deployment's bounds."""
    def bounded(c: Check) -> Check:
        if c.kind == "row_count":
            return replace(c, hi=params.dq_max_rows)
        if c.column == "review_date" and c.kind == "between":
            return replace(c, lo=params.dq_date_lo, hi=params.dq_date_hi)
        return c
    return [bounded(c) for c in SUITE]


RESULT_COLUMNS = ["check_id", "model", "column_name", "check_name", "failing_rows", "passed"]
FUSED_KINDS = ("not_null", "between", "row_count")
COUNTED_KINDS = ("unique", "accepted_values")


def _lit(v) -> Column:
    return F.lit(v).cast("date") if isinstance(v, dt.date) else F.lit(v)


def _failing_expr(c: Check) -> Column:
    """Aggregate expression giving the failing count of a fusable check."""
    if c.kind == "not_null":
        return F.count_if(F.col(c.column).isNull())
    if c.kind == "between":
        col = F.col(c.column)
        below = col < _lit(c.lo) if c.lo is not None else F.lit(False)
        above = col > _lit(c.hi) if c.hi is not None else F.lit(False)
        return F.count_if(below | above)
    if c.kind == "row_count":
        n = F.count(F.lit(1))
        below = n < c.lo if c.lo is not None else F.lit(False)
        above = n > c.hi if c.hi is not None else F.lit(False)
        return F.when(below | above, 1).otherwise(0)
    raise ValueError(c.kind)


def _row(c: Check, failing: Column) -> Column:
    f = failing.cast("long")
    return F.struct(F.lit(c.check_id).alias("check_id"), F.lit(c.model).alias("model"),
                    F.lit(c.column).cast("string").alias("column_name"), F.lit(c.kind).alias("check_name"),
                    f.alias("failing_rows"), (f == 0).alias("passed"))


def _counted(df: DataFrame, checks: list[tuple[int, Check]]) -> DataFrame:
    """(check, h1, h2) of each value of ``df`` that the numbered unique and accepted-values checks count."""
    def entry(i: int, c: Check) -> Column:
        value = F.col(c.column)
        asked = value.isNotNull() if c.kind == "unique" else F.coalesce(~value.isin(list(c.values)), F.lit(False))
        return F.when(asked, F.struct(F.lit(i).alias("check"), F.xxhash64(value).alias("h1"),
                                      F.xxhash64(F.lit(1), value).alias("h2")))
    if len(checks) == 1:
        return df.select(entry(*checks[0]).alias("e")).where(F.col("e").isNotNull()).select("e.*")
    entries = F.array(*[entry(i, c) for i, c in checks])
    return df.select(F.explode(entries).alias("e")).where(F.col("e").isNotNull()).select("e.*")


def count_checks(tables: list[tuple[DataFrame, list[Check]]]) -> DataFrame | None:
    """Results of the ``unique`` and ``accepted_values`` checks of several tables."""
    numbered, entries = [], None
    for df, checks in tables:
        own = [(len(numbered) + i, c) for i, c in enumerate(c for c in checks if c.kind in COUNTED_KINDS)]
        if own:
            numbered += own
            part = _counted(df, own)
            entries = part if entries is None else entries.unionByName(part)
    if entries is None:
        return None
    values = entries.groupBy("check", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    sums = values.agg(*[
        F.count_if((F.col("check") == i) & (F.col("n") > (1 if c.kind == "unique" else 0))).alias(f"c{i}") for i, c in numbered])
    return sums.select(F.inline(F.array(*[_row(c, F.col(f"c{i}")) for i, c in numbered])))


def run_checks(df: DataFrame, checks: list[Check], models: dict[str, DataFrame] | None = None,
               counted: bool = True) -> DataFrame | None:
    """Results of ``checks`` (all on the same model ``df``) as a DataFrame.

    ``models`` resolves the parent tables of ``relationships`` checks; without ``counted`` the unique and
    accepted-values checks are left to ``count_checks``."""
    parts: list[DataFrame] = []
    if counted and (part := count_checks([(df, checks)])) is not None:
        parts.append(part)
    fused = [c for c in checks if c.kind in FUSED_KINDS]
    if fused:
        aggs = [_failing_expr(c).alias(f"f{i}") for i, c in enumerate(fused)]
        wide = df.agg(*aggs)
        parts.append(wide.select(F.inline(F.array(*[_row(c, F.col(f"f{i}")) for i, c in enumerate(fused)]))))
    for c in checks:
        if c.kind == "columns":
            failing = 0 if list(df.columns) == list(c.values) else 1
            parts.append(df.sparkSession.range(1).select(F.inline(F.array(_row(c, F.lit(failing))))))
        elif c.kind == "relationships":
            parent = (models or {})[c.ref_model].select(F.col(c.ref_column).alias("_ref")).distinct()
            orphans = (df.select(F.col(c.column).alias("_ref")).where(F.col("_ref").isNotNull())
                       .join(parent, "_ref", "left_anti"))
            parts.append(orphans.agg(F.count(F.lit(1)).alias("n"))
                         .select(F.inline(F.array(_row(c, F.col("n"))))))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dq_report(models: dict[str, DataFrame], suite: list[Check] = SUITE, kinds=None) -> DataFrame:
    """Run every check in ``suite`` (optionally only ``kinds``) against ``models``."""
    chosen = [(df, [c for c in suite if c.model == model and (kinds is None or c.kind in kinds)]) for model, df in models.items()]
    out = count_checks(chosen)
    for df, checks in chosen:
        part = run_checks(df, checks, models, counted=False) if checks else None
        if part is not None:
            out = part if out is None else out.unionByName(part)
    return out


class QualityGateError(RuntimeError):
    pass


def gate(report: DataFrame) -> DataFrame:
    """Raise if any check failed (the report is at most a few dozen rows)."""
    failed = report.where(~F.col("passed")).select("check_id", "failing_rows").collect()
    if failed:
        raise QualityGateError("data-quality checks failed: " + ", ".join(
            f"{r.check_id} ({r.failing_rows})" for r in failed))
    return report


# Single-kind helpers (the same engine, one check kind over the given columns).
def dq_not_null(df: DataFrame, model: str, cols) -> DataFrame:
    return run_checks(df, [Check(model, "not_null", c) for c in cols])


def dq_unique(df: DataFrame, model: str, cols) -> DataFrame:
    return run_checks(df, [Check(model, "unique", c) for c in cols])


def dq_accepted_values(df: DataFrame, model: str, col: str, values) -> DataFrame:
    return run_checks(df, [Check(model, "accepted_values", col, values=tuple(values))])


def dq_row_count(df: DataFrame, model: str, lo, hi) -> DataFrame:
    return run_checks(df, [Check(model, "row_count", lo=lo, hi=hi)])


def dq_between(df: DataFrame, model: str, col: str, lo, hi) -> DataFrame:
    return run_checks(df, [Check(model, "between", col, lo=lo, hi=hi)])


def dq_columns(df: DataFrame, model: str, expected) -> DataFrame:
    return run_checks(df, [Check(model, "columns", values=tuple(expected))])


def dq_relationships(df: DataFrame, model: str, col: str, parent: DataFrame, parent_model: str,
                     parent_col: str) -> DataFrame:
    return run_checks(df, [Check(model, "relationships", col, ref_model=parent_model, ref_column=parent_col)],
                      {parent_model: parent})


# ------------------------------------------------------------------ oracle SQL
def _sql_lit(v) -> str:
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def check_sql(c: Check, relation: str) -> str:
    """DuckDB SQL for one check, written independently of the Spark path."""
    col = c.column
    if c.kind == "not_null":
        failing = f"(SELECT COUNT(*) FROM {relation} WHERE {col} IS NULL)"
    elif c.kind == "unique":
        failing = (f"(SELECT COUNT(*) FROM (SELECT {col} FROM {relation} WHERE {col} IS NOT NULL "
                   f"GROUP BY {col} HAVING COUNT(*) > 1) d)")
    elif c.kind == "accepted_values":
        vals = ", ".join(_sql_lit(v) for v in c.values)
        failing = f"(SELECT COUNT(DISTINCT {col}) FROM {relation} WHERE {col} NOT IN ({vals}))"
    elif c.kind == "between":
        tests = [f"{col} {op} {_sql_lit(v)}" for op, v in (("<", c.lo), (">", c.hi)) if v is not None]
        failing = f"(SELECT COUNT(*) FROM {relation} WHERE {' OR '.join(tests) or 'FALSE'})"
    elif c.kind == "row_count":
        tests = [f"COUNT(*) {op} {v}" for op, v in (("<", c.lo), (">", c.hi)) if v is not None]
        failing = f"(SELECT CAST({' OR '.join(tests) or 'FALSE'} AS INT) FROM {relation})"
    elif c.kind == "columns":
        failing = "0"
    elif c.kind == "relationships":
        failing = (f"(SELECT COUNT(*) FROM {relation} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
                   f"(SELECT 1 FROM {c.ref_model} p WHERE p.{c.ref_column} = c.{col}))")
    else:
        raise ValueError(c.kind)
    column = "NULL" if col is None else _sql_lit(col)
    return (f"SELECT {_sql_lit(c.check_id)} AS check_id, {_sql_lit(c.model)} AS model, "
            f"CAST({column} AS VARCHAR) AS column_name, {_sql_lit(c.kind)} AS check_name, "
            f"CAST({failing} AS BIGINT) AS failing_rows, CAST({failing} AS BIGINT) = 0 AS passed")


def suite_sql(suite: list[Check] = SUITE, kinds=None) -> str:
    return "\nUNION ALL\n".join(check_sql(c, c.model) for c in suite if kinds is None or c.kind in kinds)
