"""Column roles of an indicator pipeline.

Operators take column names; only this spec (and the query registry) knows the
domain.  Defaults are the names of the literacy-indicator pipeline that the
library reproduces, so its outputs keep those schemas.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class IndicatorSpec:
    # The column names below are those of the reproduced
    # pipeline's tables, so that its Silver, Gold and check outputs keep
    # their schemas.  Other deployments override them.
    entity: str = "id_municipio"
    period: str = "ano"
    region: str = "sigla_uf"
    region_name: str = "nome_uf"
    # name column in the raw dimension and its name after integration
    dim_name: str = "nome"
    entity_name: str = "nome_municipio"
    # microdata columns (aggregated by the weighted indicator)
    score_raw: str = "proficiencia"
    flag_raw: str = "alfabetizado"
    flag_yes: str = "1"
    weight_raw: str = "peso_aluno"
    # indicator metrics
    score: str = "proficiencia_media"
    rate: str = "percentual_alfabetizado"
    rate_decimals: int = 4
    # goals: wide columns <goal_prefix><YYYY>, long value column
    goal_prefix: str = "meta_alfabetizacao_"
    goal: str = "meta_percentual"
    gap: str = "gap_para_meta"
    hit: str = "atingiu_meta"
    null_flag_suffix: str = "_era_nulo"
    # bronze bookkeeping
    ingest_partition: str = "dt_ingestao"
    audit_date: str = "_dt_ingestao"
    audit_source: str = "_fonte"
    processed_at: str = "_dt_processamento"
    # quality thresholds
    missing_limit_pct: float = 5.0
    range_low: float = 0.0
    range_high: float = 100.0
    range_tolerance: float = 1e-6
    # natural keys per logical table, beside those that follow from the roles
    natural_keys: dict = field(default_factory=dict)

    @property
    def metrics(self) -> tuple[str, str]:
        return (self.score, self.rate)

    @property
    def cleaning_keys(self) -> tuple[str, str]:
        """Keys whose all-NULL rows are dropped by cleaning (T3)."""
        return (self.entity, self.period)

    def keys_of(self, table: str) -> list[str]:
        """Natural key of a logical table (drives the checks): entity and
        period, or for the dimension and the goals the entity."""
        roles = {"indicador": (self.entity, self.period), "municipio": (self.entity,),
                 "meta_municipio": (self.entity,), "silver": (self.entity, self.period)}
        return list({**roles, **self.natural_keys}[table])

    def null_flag(self, metric: str) -> str:
        return f"{metric}{self.null_flag_suffix}"


DEFAULT_SPEC = IndicatorSpec()
