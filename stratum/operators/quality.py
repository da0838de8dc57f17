"""Data-quality checks that can stop a run.

Each check is a lazy DataFrame with one row per check (columns ``CHECK_COLUMNS``:
name, passed, critical, status, details, metrics map).  :func:`table_checks`
fuses the duplicate, missing-value and range checks into one grouped pass and
adds the orphan check as a second job; :func:`run_gate` collects the few
result rows and raises when a critical check failed, after reporting all.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions import out_of_range

# Check names and metric keys of the reference's results.
DUPLICATES = "verificacao_duplicidade"
MISSING = "deteccao_valores_ausentes"
ORPHANS = "validacao_chave_relacionamento"
RANGE_PREFIX = "consistencia_"
M_TOTAL = "total"
M_DUPLICATES = "duplicados"
M_ORPHANS = "orfaos"
M_INVALID = "invalidos"

CHECK_COLUMNS = ["check_name", "passed", "critical", "status", "details", "metrics"]


@dataclass
class CheckResult:
    name: str
    passed: bool
    details: str
    critical: bool = True
    metrics: dict = field(default_factory=dict)

    @property
    def status(self) -> str:
        return "pass" if self.passed else ("fail" if self.critical else "warn")


class QualityGateError(RuntimeError):
    """A critical check failed; carries every result."""

    def __init__(self, failed: list[CheckResult], results: list[CheckResult]):
        super().__init__("critical checks failed: " + ", ".join(r.name for r in failed))
        self.failed = failed
        self.results = results


def _check_row(name: str, passed: Column, critical: bool, details: Column,
               metrics: dict[str, Column]) -> Column:
    kv = [x for k, v in metrics.items() for x in (F.lit(k), v.cast("double"))]
    status = F.when(passed, F.lit("pass")).otherwise(F.lit("fail" if critical else "warn"))
    return F.struct(F.lit(name).alias("check_name"), passed.alias("passed"),
                    F.lit(critical).alias("critical"), status.alias("status"),
                    details.alias("details"), F.create_map(*kv).alias("metrics"))


def _rows(agg: DataFrame, *checks: Column) -> DataFrame:
    return agg.select(F.inline(F.array(*checks)))


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


# ------------------------------------------------------------- single checks

def _duplicate_row(total: Column, dup: Column, keys: list[str]) -> Column:
    return _check_row(DUPLICATES, dup == 0, True,
                      F.concat(dup.cast("string"), F.lit(f" duplicate rows on {keys} (of "), total.cast("string"), F.lit(")")),
                      {M_TOTAL: total, M_DUPLICATES: dup})


def duplicate_check(df: DataFrame, keys: list[str]) -> DataFrame:
    """``total - number of distinct key tuples``; NULL key values count as
    values (a group-by, not ``count(DISTINCT k1, k2)``, which skips NULLs).

    One shuffle by the keys; the map side already folds repeated keys, so a
    hot key does not reach the reducers row by row.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    agg = per_key.agg(_zero(F.sum("_n")).alias("_total"), _zero(F.sum(F.col("_n") - 1)).alias("_dup"))
    return _rows(agg, _duplicate_row(F.col("_total"), F.col("_dup"), keys))


def _missing_pct(nulls: Column, total: Column) -> Column:
    """Percent of NULLs rounded to 2; an empty table is 0%."""
    return F.round(F.coalesce(F.try_divide(nulls, total) * 100, F.lit(0.0)), 2)


def _missing_row(pcts: dict[str, Column], limit: float) -> Column:
    passed = reduce(lambda a, b: a & b, [p <= F.lit(limit) for p in pcts.values()], F.lit(True))
    details = F.concat(F.lit(f"null % per column (limit {limit}%): "),
                       F.concat_ws(", ", *[F.concat(F.lit(f"{c}="), p.cast("string")) for c, p in pcts.items()]))
    return _check_row(MISSING, passed, False, details, pcts)


def missing_check(df: DataFrame, cols: Iterable[str], limit_pct: float = 5.0) -> DataFrame:
    """Non-critical: fails when a column's NULL share, already rounded to 2,
    is strictly above the limit.  All columns in one aggregate."""
    cols = list(cols)
    agg = df.agg(F.count(F.lit(1)).alias("_total"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(cols)])
    pcts = {c: _missing_pct(F.col(f"_null_{i}"), F.col("_total")) for i, c in enumerate(cols)}
    return _rows(agg, _missing_row(pcts, limit_pct))


def missing_by_column(df: DataFrame, cols: Iterable[str], limit_pct: float = 5.0) -> DataFrame:
    """Long form of the missing check: one row per column with its share."""
    cols = list(cols)
    agg = df.agg(F.count(F.lit(1)).alias("_total"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("column_name"),
                     F.col(f"_null_{i}").alias("nulls"),
                     _missing_pct(F.col(f"_null_{i}"), F.col("_total")).alias("pct"))
            for i, c in enumerate(cols)]
    return (agg.select(F.inline(F.array(*rows)))
               .withColumn("passed", F.col("pct") <= F.lit(limit_pct)))


_MATCH = "_has_parent"


def orphan_keys(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct child key tuples with no parent.  A NULL child key never
    matches, so it is an orphan even when the parent has a NULL key.

    Both sides are reduced to distinct keys first (partial aggregation on the
    map side), so the join sees each key once however skewed the child.  It
    is a LEFT join + ``IS NULL`` rather than a LEFT ANTI join because the
    optimizer pushes an anti join below the child's DISTINCT, which would
    shuffle raw child rows whenever the parent is too large to broadcast.
    """
    marked = parent.select(*keys).distinct().withColumn(_MATCH, F.lit(True))
    return (child.select(*keys).distinct().join(marked, keys, "left")
                 .filter(F.col(_MATCH).isNull()).select(*keys))


def _orphan_row(n: Column, keys: list[str]) -> Column:
    return _check_row(ORPHANS, n == 0, True,
                      F.concat(n.cast("string"), F.lit(f" keys {keys} without a parent row")), {M_ORPHANS: n})


def orphan_check(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    agg = orphan_keys(child, parent, keys).agg(F.count(F.lit(1)).alias("_orphans"))
    return _rows(agg, _orphan_row(F.col("_orphans"), keys))


def _range_row(col: str, invalid: Column, low: float, high: float) -> Column:
    return _check_row(f"{RANGE_PREFIX}{col}", invalid == 0, True,
                      F.concat(invalid.cast("string"), F.lit(f" rows with '{col}' outside [{low:g}, {high:g}]")),
                      {M_INVALID: invalid})


def range_check(df: DataFrame, col: str, low: float = 0.0, high: float = 100.0,
                tolerance: float = 1e-6) -> DataFrame:
    """Critical: values outside ``[low - tol, high + tol]``; NULL passes, NaN
    fails."""
    agg = df.agg(F.count_if(out_of_range(col, low, high, tolerance)).alias("_invalid"))
    return _rows(agg, _range_row(col, F.col("_invalid"), low, high))


# ------------------------------------------------------------- fused suite

def table_checks(df: DataFrame, parent: DataFrame, *, keys: list[str], missing_cols: list[str],
                 range_col: str, orphan_keys_cols: list[str], missing_limit: float = 5.0,
                 low: float = 0.0, high: float = 100.0, tolerance: float = 1e-6) -> DataFrame:
    """All four checks in two jobs instead of one per check and column.

    Job 1 groups by the duplicate keys and carries the NULL and out-of-range
    counts through the same partial aggregate; job 2 is the orphan-key join
    between distinct keys.  The results are unioned (no join between the
    one-row results).
    """
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(missing_cols)],
        F.count_if(out_of_range(range_col, low, high, tolerance)).alias("_invalid"))
    agg = per_key.agg(
        _zero(F.sum("_n")).alias("_total"), _zero(F.sum(F.col("_n") - 1)).alias("_dup"),
        *[_zero(F.sum(f"_null_{i}")).alias(f"_null_{i}") for i in range(len(missing_cols))],
        _zero(F.sum("_invalid")).alias("_invalid"))
    pcts = {c: _missing_pct(F.col(f"_null_{i}"), F.col("_total")) for i, c in enumerate(missing_cols)}
    fused = _rows(agg,
                  _duplicate_row(F.col("_total"), F.col("_dup"), keys),
                  _missing_row(pcts, missing_limit),
                  _range_row(range_col, F.col("_invalid"), low, high))
    return fused.unionByName(orphan_check(df, parent, orphan_keys_cols))


def collect_results(checks: DataFrame) -> list[CheckResult]:
    """The handful of result rows, on the driver."""
    return [CheckResult(r.check_name, bool(r.passed), r.details, bool(r.critical), dict(r.metrics or {}))
            for r in checks.collect()]


def run_gate(checks: DataFrame, report=print) -> list[CheckResult]:
    """Evaluate every check, report each, then raise if any critical one
    failed; a non-critical failure is reported as ``warn``."""
    results = collect_results(checks)
    for r in results:
        report(f"[quality] {r.name}: {r.status} - {r.details}")
    failed = [r for r in results if r.critical and not r.passed]
    if failed:
        raise QualityGateError(failed, results)
    return results
