"""Write the physical plan trees (and scan details) of selected queries to
docs/PLANS.md.  Usage: python scripts/dump_plans.py [sf_dir]"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, ".")

from stratum.plans import queries as Q  # noqa: E402
from stratum.session import get_session, scratch_path  # noqa: E402
from stratum.sources.bronze import read_bronze, write_snapshot  # noqa: E402
from stratum.plans import testbed as tb  # noqa: E402
from stratum.operators import quality as dq  # noqa: E402
from stratum.spec import DEFAULT_SPEC as S  # noqa: E402

NOTES = {
    "silver_integrated": "Fact side: one exchange (the weighted aggregate); the full-row dedup reuses its "
                         "(entity, period) partitioning; goals meet the fact without a new exchange. "
                         "The dimension join is planned as sort-merge and turned into a broadcast by AQE "
                         "when the runtime size is small.",
    "dq_report": "Two jobs: one grouped aggregate carrying duplicate / NULL / range counts, one anti join "
                 "between distinct keys; results unioned.",
    "kpi_distribution": "Latest period as a scalar-subquery filter; bounds as one row attached by an "
                        "equi-join on the period (broadcast of one row); partial aggregate per bin.",
    "latest_snapshot": "Scalar subquery on max(dt_ingestao) becomes a partition filter; the subquery reads "
                       "directory metadata only (empty ReadSchema).",
    "dq_orphans_large_parent": "Orphan keys with a parent too large to broadcast: both sides are reduced to "
                               "distinct keys by a partial aggregate before their exchange, and the join "
                               "reuses that partitioning (a LEFT ANTI join would be pushed below the child's "
                               "DISTINCT and shuffle raw child rows).",
}


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head = text.split("\n\n\n")[0]
    details = sorted(set(re.findall(r"(?:PartitionFilters|PushedFilters|ReadSchema): .*", text)))
    return head + "\n\n" + "\n".join(details)


def main(sf_dir="/root/testdata/sf0.1"):
    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    base = scratch_path(spark, "plans")
    write_snapshot(tb.indicator(spark, sf_dir), base, "indicador", "2024-01-01", "batch")
    write_snapshot(tb.indicator(spark, sf_dir), base, "indicador", "2024-01-02", "batch")
    frames = {
        "silver_integrated": Q.silver_integrated(spark, sf_dir),
        "dq_report": Q.dq_report(spark, sf_dir),
        "kpi_distribution": Q.kpi_distribution(spark, sf_dir),
        "latest_snapshot": read_bronze(spark, base, "indicador"),
        "dq_orphans_large_parent": dq.orphan_keys(Q.silver(spark, sf_dir),
                                                  tb.dimension(spark, sf_dir).hint("shuffle_merge"), [S.entity]),
    }
    out = ["# Physical plans", "",
           f"Generated by `scripts/dump_plans.py` at `{sf_dir}` before execution (AQE may still switch "
           "sort-merge joins to broadcast joins and coalesce partitions at run time).", ""]
    for name, df in frames.items():
        out += [f"## {name}", "", NOTES[name], "", "```", tree(df).strip(), "```", ""]
    spark.stop()
    with open("docs/PLANS.md", "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main(*sys.argv[1:2])
