"""stratum: layered indicator pipelines on Spark DataFrames.

Raw tables land as dated snapshots (bronze), are cleaned and integrated into
one row per entity and period (silver), gated by data-quality checks, and
turned into analytic marts and report queries (gold).  Everything is built
from DataFrame / SQL / Structured Streaming expressions; no Python UDFs.
"""

from stratum.spec import IndicatorSpec

__all__ = ["IndicatorSpec"]
