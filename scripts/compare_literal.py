"""Literal (reference-shaped) vs fused forms of three steps, timed at one
scale: count-then-write vs Observation, one-scan-per-year union vs unpivot,
one job per check vs the fused checks.  Prints one JSON line."""

from __future__ import annotations

import contextlib
import io
import json
import os
import statistics
import sys
import time
from functools import reduce

sys.path.insert(0, ".")

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from stratum.operators import quality as dq  # noqa: E402
from stratum.operators.cleaning import flag_missing  # noqa: E402
from stratum.operators.integrate import attach_dimension, attach_goals  # noqa: E402
from stratum.plans.silver import silver_columns  # noqa: E402
from stratum.operators.reshape import goals_long  # noqa: E402
from stratum.plans import queries as Q  # noqa: E402
from stratum.plans import testbed as tb  # noqa: E402
from stratum.plans.silver import prepare  # noqa: E402
from stratum.session import get_session, scratch_path  # noqa: E402
from stratum.sources.layers import read_silver, write_silver  # noqa: E402
from stratum.sources.metrics import observed_write  # noqa: E402
from stratum.spec import DEFAULT_SPEC as S  # noqa: E402


def timed(fn, repeats):
    fn()
    return round(statistics.median(_once(fn) for _ in range(repeats)), 3)


def _once(fn):
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def scans(df: DataFrame) -> int:
    """Number of file scans in the physical plan (from ``explain``)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().count("FileScan")


def silver_in_order(spark, sf_dir, order: str) -> DataFrame:
    """Silver with the two LEFT joins in the given order (same result)."""
    fact = flag_missing(prepare(tb.indicator(spark, sf_dir)), S.metrics, S.null_flag_suffix)
    dim = prepare(tb.dimension(spark, sf_dir))
    goals = goals_long(prepare(tb.goals_wide(spark, sf_dir)), S.entity, S.goal_prefix, period=S.period, value=S.goal)
    cols = {S.region: S.region, S.region_name: S.region_name, S.dim_name: S.entity_name}
    if order == "dimension_first":
        joined = attach_goals(attach_dimension(fact, dim, S.entity, columns=cols), goals, [S.entity, S.period])
    else:
        joined = attach_dimension(attach_goals(fact, goals, [S.entity, S.period]), dim, S.entity, columns=cols)
    return joined.select(*silver_columns(S))


def hash_exchanges(df: DataFrame) -> int:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().count("Exchange hashpartitioning")


def union_goals(wide: DataFrame) -> DataFrame:
    parts = [wide.select(S.entity, F.lit(y).alias(S.period), F.col(f"{S.goal_prefix}{y}").cast("double").alias(S.goal))
             for y in tb.GOAL_YEARS]
    return reduce(DataFrame.unionByName, parts).groupBy(S.entity, S.period).agg(F.avg(S.goal).alias(S.goal))


def literal_checks(silver, parent):
    total = silver.count()
    distinct = silver.select(S.entity, S.period).distinct().count()
    nulls = [silver.filter(F.col(c).isNull()).count() for c in S.metrics]
    total2 = silver.count()
    orphans = dq.orphan_keys(silver, parent, [S.entity]).count()
    invalid = silver.filter(dq.out_of_range(S.rate, 0, 100, 1e-6)).count()
    return total, distinct, nulls, total2, orphans, invalid


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = get_session(f"local[{cpus}]", conf={"spark.sql.shuffle.partitions": cpus})
    silver = Q.silver(spark, sf_dir)
    out = {}

    def count_then_write():
        silver.count()
        write_silver(silver, scratch_path(spark, "cmp"))

    def observe_write():
        observed_write(silver, lambda d: write_silver(d, scratch_path(spark, "cmp")), "silver", "silver")

    out["count_then_write"] = timed(count_then_write, repeats)
    out["observation_write"] = timed(observe_write, repeats)

    wide = prepare(tb.goals_wide(spark, sf_dir))
    out["goals_union_7_scans"] = timed(lambda: union_goals(wide).write.format("noop").mode("overwrite").save(), repeats)
    out["goals_unpivot"] = timed(lambda: goals_long(wide, S.entity, S.goal_prefix, period=S.period, value=S.goal)
                                 .write.format("noop").mode("overwrite").save(), repeats)
    out["goals_union_file_scans"] = scans(union_goals(wide))
    out["goals_unpivot_file_scans"] = scans(goals_long(wide, S.entity, S.goal_prefix, period=S.period, value=S.goal))

    path = write_silver(silver, scratch_path(spark, "cmp"))
    written = read_silver(spark, path)
    parent = tb.dimension(spark, sf_dir)
    out["checks_one_job_each"] = timed(lambda: literal_checks(written, parent), repeats)
    out["checks_fused"] = timed(lambda: dq.collect_results(dq.table_checks(
        written, parent, keys=[S.entity, S.period], missing_cols=list(S.metrics), range_col=S.rate,
        orphan_keys_cols=[S.entity])), repeats)
    # join order with a dimension too large to broadcast (broadcasts disabled)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for order in ("dimension_first", "goals_first"):
        out[f"silver_{order}"] = timed(lambda o=order: silver_in_order(spark, sf_dir, o)
                                       .write.format("noop").mode("overwrite").save(), repeats)
        out[f"silver_{order}_hash_exchanges"] = hash_exchanges(silver_in_order(spark, sf_dir, order))
    spark.stop()
    print(json.dumps({"sf_dir": sf_dir, "cpus": int(cpus), "repeats": repeats, "seconds": out}))


if __name__ == "__main__":
    main()
