"""Data-quality checks (K1-K9): one result row per declared test.

The row-level checks of a model (not_null, accepted_range, bounding box) are
conditional counts: observed by the tasks that write the model (``RowChecks``),
or of one ungrouped aggregate over a table that is there already; each key that checks group by
(unique, accepted values, unique combination) is counted by itself, so no row
is expanded; relationships anti-join the counted keys. Failure counts follow
the usual data-test conventions:

  not_null              rows where the column is NULL
  unique                distinct non-NULL values seen more than once
  accepted_values       distinct non-NULL values outside the list
  relationships         child rows (non-NULL key) with no parent
  unique_combination    column combinations seen more than once (NULLs group)
  accepted_range        rows outside [min, max] (NULL passes)
  bbox (singular)       located rows outside the box

Status: pass when nothing fails; fail when ``error_if`` holds; otherwise
``warn`` for warn-severity tests and ``fail`` for the rest.
"""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    id: int
    model: str
    kind: str
    column: str | None = None
    args: Mapping = field(default_factory=dict)
    severity: str = "error"
    error_if: str | None = None


ROW_KINDS = ("not_null", "accepted_range", "bbox")

_OPS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
        "=": operator.eq, "!=": operator.ne}


def _parse_threshold(expr: str):
    for sym in (">=", "<=", "!=", ">", "<", "="):
        if expr.startswith(sym):
            return sym, int(expr[len(sym):])
    raise ValueError(expr)


def status_col(failures: Column, severity: Column | str, error_if: str | None) -> Column:
    sev = F.lit(severity) if isinstance(severity, str) else severity
    err = F.lit(False)
    if error_if:
        sym, n = _parse_threshold(error_if)
        err = _OPS[sym](failures, F.lit(n))
    return (F.when(failures == 0, F.lit("pass")).when(err, F.lit("fail"))
            .when(sev == "warn", F.lit("warn")).otherwise(F.lit("fail")))


def _row_failure(df: DataFrame, c: Check) -> Column:
    if c.kind == "not_null":
        return F.count_if(F.col(c.column).isNull())
    if c.kind == "accepted_range":
        x = F.col(c.column)
        return F.count_if(~((x >= F.lit(c.args["min"])) & (x <= F.lit(c.args["max"]))))
    if c.kind == "bbox":
        la, lo = F.col(c.args["lat"]), F.col(c.args["lon"])
        out = ((la > F.lit(c.args["lat_max"])) | (la < F.lit(c.args["lat_min"]))
               | (lo > F.lit(c.args["lon_max"])) | (lo < F.lit(c.args["lon_min"])))
        return F.count_if(la.isNotNull() & lo.isNotNull() & out)
    raise ValueError(c.kind)


def _result_rows(checks: Sequence[Check], counts: DataFrame) -> DataFrame:
    """Unpivot a one-row frame of failure counts (column f<id>) into rows."""
    entries = [F.struct(F.lit(c.id).cast("bigint").alias("test_id"),
                        F.col(f"f{c.id}").cast("bigint").alias("failures")) for c in checks]
    return counts.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


class RowChecks:
    """Row-level checks of one model, counted while it is written: no second scan.
    The others among ``checks`` are left to ``run_checks``."""

    def __init__(self, checks: Sequence[Check]):
        self.checks = [c for c in checks if c.kind in ROW_KINDS]
        self.observation = Observation() if self.checks else None

    def watch(self, df: DataFrame) -> DataFrame:
        """Put directly before the write, in its last stage: a stage before a range
        shuffle runs once more for the sample, and would count twice."""
        if self.observation is None:
            return df
        return df.observe(self.observation, *[_row_failure(df, c).alias(f"f{c.id}") for c in self.checks])

    def failures(self) -> dict[int, int]:
        """Failures by test id, after the write."""
        return {c.id: int(self.observation.get[f"f{c.id}"]) for c in self.checks}


def _key_of(c: Check) -> tuple[str, ...]:
    return tuple(c.args["columns"]) if c.kind == "unique_combination" else (c.column,)


def _group_failure(c: Check) -> Column:
    n = F.col("__n")
    if c.kind == "unique_combination":
        return F.count_if(n > 1)
    x = F.col(c.column)
    if c.kind == "unique":
        return F.count_if(x.isNotNull() & (n > 1))
    if c.kind == "accepted_values":
        return F.count_if(x.isNotNull() & ~x.isin(*c.args["values"]))
    raise ValueError(c.kind)


def _model_failures(df: DataFrame, cs: Sequence[Check]) -> list[DataFrame]:
    """All checks of one model but relationships: one ungrouped aggregate for the
    row-level counts, which shuffles a row per task, and for each key that checks
    group by one narrow count per key value, reading the key's columns only."""
    rows = [c for c in cs if c.kind in ROW_KINDS]
    out = [_result_rows(rows, df.agg(*[_row_failure(df, c).alias(f"f{c.id}") for c in rows]))] if rows else []
    by_key: dict[tuple[str, ...], list[Check]] = {}
    for c in cs:
        if c.kind not in ROW_KINDS:
            by_key.setdefault(_key_of(c), []).append(c)
    for key, checks in by_key.items():
        counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
        out.append(_result_rows(checks, counts.agg(*[_group_failure(c).alias(f"f{c.id}") for c in checks])))
    return out


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check],
               counted: Mapping[int, int] | None = None) -> DataFrame:
    """Run ``checks`` against ``tables`` (model name -> DataFrame). ``counted`` has
    failures by test id that are known already: their tables are not read again."""
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    counted = {c.id: counted[c.id] for c in checks if c.id in counted} if counted else {}
    if counted:
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.createDataFrame(list(counted.items()), "test_id bigint, failures bigint"))
    for c in checks:
        if c.id not in counted:
            by_model.setdefault(c.model, []).append(c)
    for model, cs in by_model.items():
        df = tables[model]
        local = [c for c in cs if c.kind != "relationships"]
        if local:
            parts += _model_failures(df, local)
        for c in cs:
            if c.kind == "relationships":
                parent = tables[c.args["to"]].select(F.col(c.args["field"]).alias("__k")).distinct()
                # Rows per key first: a key with a third of the rows is one row of the join.
                child = df.filter(F.col(c.column).isNotNull()).groupBy(F.col(c.column).alias("__k")).agg(
                    F.count(F.lit(1)).alias("__n"))
                n = child.join(parent, "__k", "left_anti").agg(
                    F.coalesce(F.sum("__n"), F.lit(0)).alias(f"f{c.id}"))
                parts.append(_result_rows([c], n))
    results = reduce(DataFrame.unionByName, parts)
    meta = results.sparkSession.createDataFrame(
        [(c.id, c.model, c.kind, c.column, c.severity, c.error_if) for c in checks],
        "test_id bigint, model string, test string, column_name string, severity string, error_if string")
    joined = results.join(F.broadcast(meta), "test_id")
    status = F.lit(None).cast("string")
    for threshold in sorted({c.error_if for c in checks if c.error_if}):
        status = F.when(F.col("error_if") == threshold,
                        status_col(F.col("failures"), F.col("severity"), threshold)).otherwise(status)
    status = F.coalesce(status, status_col(F.col("failures"), F.col("severity"), None))
    return joined.select("test_id", "model", "test", "column_name", "failures", status.alias("status"))
