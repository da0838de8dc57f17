"""Bronze layer: raw rows plus audit columns, one partition per ingestion
date; a rerun on the same date replaces only that date."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.bronze import with_audit
from stratum.sources.files import names
from stratum.spec import DEFAULT_SPEC, IndicatorSpec


def table_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


def write_snapshot(df: DataFrame, base: str, table: str, ingest_date: str, source: str,
                   spec: IndicatorSpec = DEFAULT_SPEC) -> str:
    """Append-or-replace the ``ingest_date`` partition of ``table``.

    Dynamic partition overwrite touches only the partitions present in the
    written data, so older dates stay and a same-day rerun is idempotent.
    """
    s = spec
    path = table_path(base, table)
    (with_audit(df, ingest_date, source, audit_date=s.audit_date, audit_source=s.audit_source,
                partition=s.ingest_partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(s.ingest_partition)
        .parquet(path))
    return path


def latest_snapshot(df: DataFrame, partition: str = "dt_ingestao") -> DataFrame:
    """Rows of the table-wide latest partition (not latest per key).

    The max is a scalar subquery, so there is no eager job; on a partitioned
    table it becomes a partition filter evaluated before the scan.  An empty
    table gives a NULL max and so no rows.  No-op without the column.
    """
    if partition not in df.columns:
        return df
    return df.filter(F.col(partition) == df.select(F.max(partition)).scalar())


def dates(spark: SparkSession, path: str, partition: str = "dt_ingestao") -> list[str]:
    """The ingestion dates of a table, ascending, from its folders' names: no
    file is opened and no job runs."""
    found = [n.removeprefix(f"{partition}=") for n in names(spark, path) if n.startswith(f"{partition}=")]
    return sorted(d for d in found if d != "__HIVE_DEFAULT_PARTITION__")


def common_type(kinds: set[str]) -> str:
    """A type that holds the values of all of these: whole numbers the longest
    of them, other numbers a double, anything else text."""
    whole = ["tinyint", "smallint", "int", "bigint"]
    if len(kinds) == 1:
        return next(iter(kinds))
    if kinds <= set(whole):
        return max(kinds, key=whole.index)
    return "double" if kinds <= {*whole, "float", "double"} else "string"


def read_history(spark: SparkSession, path: str, partition: str = "dt_ingestao") -> DataFrame:
    """All dates, with the columns of any; where a column's type has changed
    between dates, values get :func:`common_type`.

    Each date is read by its own schema, dates with the same one together, so
    there are as many scans as different schemas.
    """
    days = dates(spark, path, partition)
    if not days:
        return spark.read.parquet(path)
    reader = spark.read.option("basePath", path)
    with ThreadPoolExecutor(max_workers=8) as pool:  # one footer for each date
        schemas = list(pool.map(lambda d: reader.parquet(f"{path}/{partition}={d}").schema, days))
    alike: dict[str, list[int]] = {}
    for k, schema in enumerate(schemas):
        alike.setdefault(schema.json(), []).append(k)
    kinds: dict[str, set[str]] = {}
    for schema in schemas:
        for f in schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
    parts = []
    for at in alike.values():
        df = reader.schema(schemas[at[0]]).parquet(*[f"{path}/{partition}={days[k]}" for k in at])
        parts.append(df.select(*[df[f"`{c}`"].cast(common_type(kinds[c])).alias(c) for c in df.columns]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_bronze(spark: SparkSession, base: str, table: str, *, latest: bool = True,
                spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """The latest date's rows with that date's own columns, or all dates
    (:func:`read_history`).  Only the latest date's folder is listed and its
    footers read."""
    path, part = table_path(base, table), spec.ingest_partition
    if not latest:
        return read_history(spark, path, part)
    days = dates(spark, path, part)
    if not days:
        return spark.read.parquet(path)
    return spark.read.option("basePath", path).parquet(f"{path}/{part}={days[-1]}")
