"""Mapping of the driver's TPC-H-like tables onto the pipeline's roles.

* microdata: one ``lineitem`` row per observation -- entity = supplier key,
  period = ship year, score = extended price, flag = '1' when the return flag
  is 'N', weight = quantity;
* dimension: supplier x nation x region for suppliers with a non-negative
  account balance (the others are unregistered, so some entities have no
  dimension row); region code = nation name, region name = region name;
* wide goals: one row per (supplier, line status) -- the line status plays the
  school network -- with ``meta_alfabetizacao_<Y>`` = share of 'N' lines in the
  previous year, so the first year has no basis and is NULL everywhere.

Everything is a lazy read of the given tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions import share_pct
from stratum.operators.bronze import indicator_of
from stratum.spec import DEFAULT_SPEC, IndicatorSpec

# Fixed values of the test mapping: goal years (one column each) and the
# return flag that marks a "yes" observation.
GOAL_YEARS = (1995, 1996, 1997, 1998, 1999, 2000, 2001)
YES_RETURN_FLAG = "N"
NETWORK = "rede"


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_L, _I, _D, _S, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()

# Declared schemas of the tables read here: no schema-inference job per read,
# and a type change in the files fails loudly instead of flowing downstream.
SCHEMAS = {
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I),
                        ("l_quantity", _D), ("l_extendedprice", _D), ("l_discount", _D), ("l_tax", _D),
                        ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _TS)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "events": _schema(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S), ("value", _D),
                      ("props", _S)),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def microdata(spark: SparkSession, sf_dir: str, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    return microdata_of(table(spark, sf_dir, "lineitem"), spec)


def microdata_of(lines: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """Some rows of ``lineitem`` as observations."""
    s = spec
    return lines.select(
        F.col("l_suppkey").cast("string").alias(s.entity),
        F.year("l_shipdate").alias(s.period),
        F.col("l_extendedprice").alias(s.score_raw),
        F.when(F.col("l_returnflag") == YES_RETURN_FLAG, F.lit("1")).otherwise(F.lit("0")).alias(s.flag_raw),
        F.col("l_quantity").alias(s.weight_raw),
    )


def indicator(spark: SparkSession, sf_dir: str, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """The raw indicator table: weighted aggregate of the microdata."""
    return indicator_of(microdata(spark, sf_dir, spec), spec)


def dimension(spark: SparkSession, sf_dir: str, spec: IndicatorSpec = DEFAULT_SPEC, *,
              registered_only: bool = True) -> DataFrame:
    """Entity dimension; ``registered_only=False`` keeps every supplier."""
    s = spec
    sup = table(spark, sf_dir, "supplier")
    if registered_only:
        sup = sup.filter(F.col("s_acctbal") >= 0)
    nat = table(spark, sf_dir, "nation")
    reg = table(spark, sf_dir, "region")
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
               .join(reg, nat.n_regionkey == reg.r_regionkey)
               .select(F.col("s_suppkey").cast("string").alias(s.entity),
                       F.col("s_name").alias(s.dim_name),
                       F.col("n_name").alias(s.region),
                       F.col("r_name").alias(s.region_name)))


def goals_wide(spark: SparkSession, sf_dir: str, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """One conditional aggregate per goal year, all in one pass over lineitem."""
    s = spec
    li = table(spark, sf_dir, "lineitem")
    year = F.year("l_shipdate")
    yes = F.col("l_returnflag") == YES_RETURN_FLAG
    return li.groupBy(F.col("l_suppkey").cast("string").alias(s.entity),
                      F.col("l_linestatus").alias(NETWORK)).agg(
        *[share_pct(yes, year == F.lit(y - 1), 2).alias(f"{s.goal_prefix}{y}") for y in GOAL_YEARS])


def registry(sf_dir: str, spec: IndicatorSpec = DEFAULT_SPEC, *, registered_only: bool = True):
    """Logical sources of the pipeline over the test tables."""
    from stratum.sources.registry import SourceRegistry
    return SourceRegistry({
        "indicador": lambda spark: indicator(spark, sf_dir, spec),
        "municipio": lambda spark: dimension(spark, sf_dir, spec, registered_only=registered_only),
        "meta_municipio": lambda spark: goals_wide(spark, sf_dir, spec),
    })
