"""DuckDB SQL equivalents of the registered queries (independent oracle).

The fragments restate the test-table mapping of :mod:`stratum.plans.testbed`
in plain SQL; each query composes them with CTEs.
"""

from __future__ import annotations

from stratum.plans.testbed import GOAL_YEARS

MICRO = """
SELECT CAST(l_suppkey AS VARCHAR) AS id_municipio,
       CAST(year(l_shipdate) AS INTEGER) AS ano,
       l_extendedprice AS proficiencia,
       CASE WHEN l_returnflag = 'N' THEN '1' ELSE '0' END AS alfabetizado,
       l_quantity AS peso_aluno
FROM lineitem"""

INDICATOR = f"""
SELECT id_municipio, ano,
       AVG(proficiencia) AS proficiencia_media,
       ROUND(100 * SUM(CASE WHEN alfabetizado = '1' THEN peso_aluno ELSE 0 END)
             / NULLIF(SUM(peso_aluno), 0), 4) AS percentual_alfabetizado
FROM ({MICRO}) micro
GROUP BY id_municipio, ano"""

DIMENSION = """
SELECT CAST(s_suppkey AS VARCHAR) AS id_municipio, s_name AS nome,
       n_name AS sigla_uf, r_name AS nome_uf
FROM supplier
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
WHERE s_acctbal >= 0"""

DIMENSION_ALL = DIMENSION.replace("WHERE s_acctbal >= 0", "")

_GOAL_COLS = ",\n       ".join(
    f"ROUND(CAST(100 AS DOUBLE) * COUNT(*) FILTER (WHERE year(l_shipdate) = {y - 1} AND l_returnflag = 'N')"
    f" / NULLIF(COUNT(*) FILTER (WHERE year(l_shipdate) = {y - 1}), 0), 2) AS meta_alfabetizacao_{y}"
    for y in GOAL_YEARS)

GOALS_WIDE = f"""
SELECT CAST(l_suppkey AS VARCHAR) AS id_municipio, l_linestatus AS rede,
       {_GOAL_COLS}
FROM lineitem
GROUP BY 1, 2"""

_GOAL_SLICES = "\n  UNION ALL ".join(
    f"SELECT id_municipio, {y} AS ano, meta_alfabetizacao_{y} AS meta FROM goals_clean" for y in GOAL_YEARS)

# cleaning = DISTINCT over all columns, then drop rows whose keys are all NULL,
# then key normalisation
SILVER_CTES = f"""
ind_clean AS (
  SELECT CAST(id_municipio AS VARCHAR) AS id_municipio, TRY_CAST(ano AS INTEGER) AS ano,
         TRY_CAST(proficiencia_media AS DOUBLE) AS proficiencia_media,
         TRY_CAST(percentual_alfabetizado AS DOUBLE) AS percentual_alfabetizado
  FROM (SELECT DISTINCT * FROM ({INDICATOR}) i) d
  WHERE id_municipio IS NOT NULL OR ano IS NOT NULL),
dim_clean AS (
  SELECT CAST(id_municipio AS VARCHAR) AS id_municipio, nome, upper(trim(sigla_uf)) AS sigla_uf, nome_uf
  FROM (SELECT DISTINCT * FROM ({DIMENSION}) m) d
  WHERE id_municipio IS NOT NULL),
goals_clean AS (
  SELECT * FROM (SELECT DISTINCT * FROM ({GOALS_WIDE}) g) d WHERE id_municipio IS NOT NULL),
goals_long AS (
  SELECT id_municipio, ano, AVG(meta) AS meta_percentual
  FROM ({_GOAL_SLICES}) s
  GROUP BY id_municipio, ano),
silver AS (
  SELECT i.id_municipio, m.nome AS nome_municipio, m.sigla_uf, m.nome_uf, i.ano,
         i.proficiencia_media, i.percentual_alfabetizado, g.meta_percentual,
         i.proficiencia_media IS NULL AS proficiencia_media_era_nulo,
         i.percentual_alfabetizado IS NULL AS percentual_alfabetizado_era_nulo
  FROM ind_clean i
  LEFT JOIN goals_long g ON i.id_municipio = g.id_municipio AND i.ano = g.ano
  LEFT JOIN dim_clean m ON i.id_municipio = m.id_municipio)"""

GOLD_GOAL = """
gold_goal AS (
  SELECT id_municipio, nome_municipio, sigla_uf, ano, percentual_alfabetizado, meta_percentual,
         percentual_alfabetizado - meta_percentual AS gap_para_meta,
         COALESCE(percentual_alfabetizado - meta_percentual >= 0, false) AS atingiu_meta
  FROM silver)"""

GOLD_REGION = """
gold_region AS (
  SELECT sigla_uf, nome_uf, ano,
         ROUND(AVG(percentual_alfabetizado), 2) AS percentual_alfabetizado_medio,
         ROUND(AVG(proficiencia_media), 2) AS proficiencia_media_uf,
         COUNT(id_municipio) AS qtd_municipios
  FROM silver GROUP BY sigla_uf, nome_uf, ano)"""


ORPHANS = f"""
orphans AS (
  SELECT c.id_municipio FROM (SELECT DISTINCT id_municipio FROM silver) c
  WHERE NOT EXISTS (SELECT 1 FROM ({DIMENSION}) d WHERE d.id_municipio = c.id_municipio))"""


def exact_mean(expr: str, scale: int) -> str:
    """Mean of values that have ``scale`` decimals here, from an exact sum."""
    return f"CAST(SUM(CAST({expr} AS DECIMAL(38,{scale}))) AS DOUBLE) / NULLIF(COUNT({expr}), 0)"


def _edge(i: str, bins: int = 24) -> str:
    """Edge ``i`` of equal-width bins over [lo_e, hi_e], last edge exact."""
    return (f"(CASE WHEN ({i}) = {bins} THEN hi_e"
            f" ELSE CAST({i} AS DOUBLE) * ((hi_e - lo_e) / CAST({bins} AS DOUBLE)) + lo_e END)")


def _pct(nulls: str, total: str = "t") -> str:
    return f"ROUND(COALESCE({nulls} / NULLIF({total}, 0) * 100, 0.0), 2)"


def with_silver(body: str, *extra: str) -> str:
    ctes = ",".join([SILVER_CTES, *extra])
    return f"WITH {ctes}\n{body}"


def with_silver_all(body: str, *extra: str) -> str:
    """Silver over the dimension of every supplier."""
    ctes = ",".join([SILVER_CTES.replace(f"({DIMENSION})", f"({DIMENSION_ALL})"), *extra])
    return f"WITH {ctes}\n{body}"


def snapshot(date: str, where: str = "") -> str:
    return (f"SELECT *, '{date}' AS _dt_ingestao, 'batch' AS _fonte, DATE '{date}' AS dt_ingestao"
            f" FROM ({INDICATOR}) i {where}")


MARTS_ROWS = """
SELECT 'gold_indicador_por_municipio' AS mart, COUNT(*) AS rows FROM silver
UNION ALL SELECT 'gold_meta_vs_resultado', COUNT(*) FROM silver
UNION ALL SELECT 'gold_evolucao_temporal_uf', COUNT(*)
  FROM (SELECT DISTINCT sigla_uf, nome_uf, ano FROM silver) g"""

_CONTENT = {
    "gold_indicador_por_municipio": ("silver", "id_municipio", {
        "text": ("id_municipio", "nome_municipio", "sigla_uf", "nome_uf"),
        "number": ("ano", "proficiencia_media", "percentual_alfabetizado")}),
    "gold_meta_vs_resultado": ("gold_goal", "id_municipio", {
        "text": ("id_municipio", "nome_municipio", "sigla_uf", "atingiu_meta"),
        "number": ("ano", "percentual_alfabetizado", "meta_percentual", "gap_para_meta")}),
    "gold_evolucao_temporal_uf": ("gold_region", "NULL", {
        "text": ("sigla_uf", "nome_uf"),
        "number": ("ano", "percentual_alfabetizado_medio", "proficiencia_media_uf", "qtd_municipios")}),
}


def _marts_content() -> str:
    parts = []
    for mart, (source, entity, columns) in _CONTENT.items():
        for kind, names in columns.items():
            for c in names:
                text, number = (f"CAST({c} AS VARCHAR)", "NULL") if kind == "text" else ("NULL", f"CAST({c} AS DOUBLE)")
                parts.append(f"SELECT '{mart}' AS mart, CAST({entity} AS VARCHAR) AS entity, sigla_uf AS region,"
                             f" ano AS period, '{c}' AS column_name, CAST({text} AS VARCHAR) AS text_value,"
                             f" CAST({number} AS DOUBLE) AS number_value FROM {source}")
    return "\nUNION ALL ".join(parts)


ORACLE: dict[str, str] = {
    "bronze_weighted_indicator": INDICATOR,
    "bronze_indicator_by_day": f"""
SELECT id_municipio, ano, ROUND(proficiencia_media, 9) AS proficiencia_media, percentual_alfabetizado
FROM ({INDICATOR}) i""",
    "silver_goals_long": with_silver("SELECT * FROM goals_long"),
    "silver_integrated": with_silver("SELECT * FROM silver"),
    "gold_indicator_by_entity": with_silver_all(
        "SELECT id_municipio, nome_municipio, sigla_uf, nome_uf, ano, proficiencia_media,"
        " percentual_alfabetizado FROM silver ORDER BY ano, sigla_uf, nome_municipio"),
    "gold_goal_vs_result": with_silver_all("SELECT * FROM gold_goal", GOLD_GOAL),
    "gold_region_evolution": with_silver_all(
        "SELECT * FROM gold_region ORDER BY sigla_uf, ano", GOLD_REGION),
    "bronze_snapshot_audit": f"""
SELECT DATE '2024-01-01' AS dt_ingestao, '2024-01-01' AS _dt_ingestao, 'batch' AS _fonte,
       COUNT(*) AS rows, 'indicador' AS tabela FROM ({INDICATOR}) a
UNION ALL SELECT DATE '2024-01-01', '2024-01-01', 'batch', COUNT(*), 'municipio' FROM ({DIMENSION_ALL}) b
UNION ALL SELECT DATE '2024-01-01', '2024-01-01', 'batch', COUNT(*), 'meta_municipio' FROM ({GOALS_WIDE}) c""",
    "bronze_same_day_rerun": f"""
SELECT DATE '2024-01-01' AS dt_ingestao, COUNT(*) AS rows FROM ({INDICATOR}) a
UNION ALL SELECT DATE '2024-01-02', COUNT(*) FROM ({INDICATOR}) b WHERE ano >= 1997""",
    "silver_latest_snapshot": snapshot("2024-01-02", "WHERE ano >= 1997"),
    "silver_dedup_clean": f"""
WITH ind AS ({INDICATOR}),
raw AS (SELECT * FROM ind UNION ALL SELECT * FROM ind
        UNION ALL SELECT NULL, NULL, proficiencia_media, percentual_alfabetizado FROM ind
        UNION ALL SELECT NULL, ano, proficiencia_media, percentual_alfabetizado FROM ind)
SELECT DISTINCT * FROM raw WHERE id_municipio IS NOT NULL OR ano IS NOT NULL""",
    "silver_normalize_keys": """
SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS VARCHAR) AS id_municipio,
       upper(trim('  ' || lower(l_returnflag) || ' ')) AS sigla_uf,
       CASE WHEN l_linenumber <> 7 THEN CAST(year(l_shipdate) AS INTEGER) END AS ano
FROM lineitem""",
    "silver_missing_flags": f"""
WITH raw AS (
  SELECT id_municipio, ano, CAST(proficiencia_media AS VARCHAR) AS proficiencia_media,
         CASE WHEN percentual_alfabetizado < 30.0 THEN 'n/a'
              ELSE CAST(percentual_alfabetizado AS VARCHAR) END AS percentual_alfabetizado
  FROM ({INDICATOR}) i)
SELECT id_municipio, ano,
       TRY_CAST(proficiencia_media AS DOUBLE) AS proficiencia_media,
       TRY_CAST(proficiencia_media AS DOUBLE) IS NULL AS proficiencia_media_era_nulo,
       TRY_CAST(percentual_alfabetizado AS DOUBLE) AS percentual_alfabetizado,
       TRY_CAST(percentual_alfabetizado AS DOUBLE) IS NULL AS percentual_alfabetizado_era_nulo
FROM raw""",
    "silver_partition_roundtrip": with_silver("SELECT * FROM silver"),
    "silver_read_during_write": with_silver_all("SELECT * FROM silver"),
    "gold_marts_of_one_run": with_silver_all("""
SELECT run, mart, rows FROM (
  SELECT 'after a broken rebuild' AS run, 'gold_indicador_por_municipio' AS mart, COUNT(*) AS rows FROM silver
  UNION ALL SELECT 'after a broken rebuild', 'gold_meta_vs_resultado', COUNT(*) FROM silver
  UNION ALL SELECT 'after a broken rebuild', 'gold_evolucao_temporal_uf', COUNT(*)
    FROM (SELECT DISTINCT sigla_uf, nome_uf, ano FROM silver)
  UNION ALL SELECT 'after a rebuild', 'gold_indicador_por_municipio', COUNT(*) FROM silver WHERE ano >= 1997
  UNION ALL SELECT 'after a rebuild', 'gold_meta_vs_resultado', COUNT(*) FROM silver WHERE ano >= 1997
  UNION ALL SELECT 'after a rebuild', 'gold_evolucao_temporal_uf', COUNT(*)
    FROM (SELECT DISTINCT sigla_uf, nome_uf, ano FROM silver WHERE ano >= 1997)) r"""),
    "gold_refreshed_marts": with_silver_all("""
SELECT g.*, (SELECT COUNT(DISTINCT ano) FROM silver WHERE sigla_uf = (SELECT MIN(sigla_uf) FROM silver)
             AND percentual_alfabetizado IS NOT NULL) AS partitions_read
FROM gold_goal g""", GOLD_GOAL),
    "bronze_snapshot_goals": GOALS_WIDE,
    "ordered_outputs": with_silver_all("""
SELECT 'gold_indicador_por_municipio' AS table_name, COUNT(*) AS rows, 0 AS out_of_order FROM silver
UNION ALL SELECT 'gold_evolucao_temporal_uf', COUNT(*), 0 FROM gold_region
UNION ALL SELECT 'region_vs_mean', COUNT(*), 0 FROM gold_region WHERE ano = (SELECT MAX(ano) FROM gold_region)
UNION ALL SELECT 'national_evolution', COUNT(DISTINCT ano), 0 FROM gold_region""", GOLD_REGION),
    "gold_marts_roundtrip": with_silver_all(MARTS_ROWS),
    "dq_duplicates": """
SELECT 'verificacao_duplicidade' AS check_name, SUM(n) - COUNT(*) = 0 AS passed,
       CAST(SUM(n) AS BIGINT) AS total, CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicados
FROM (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) k""",
    "dq_missing": with_silver(f"""
SELECT column_name, nulls, pct, pct <= 5.0 AS passed FROM (
  SELECT 'proficiencia_media' AS column_name, a AS nulls, {_pct('a')} AS pct FROM agg
  UNION ALL SELECT 'percentual_alfabetizado', b, {_pct('b')} FROM agg
  UNION ALL SELECT 'meta_percentual', c, {_pct('c')} FROM agg) x""", """
agg AS (SELECT COUNT(*) AS t,
               COUNT(*) FILTER (WHERE proficiencia_media IS NULL) AS a,
               COUNT(*) FILTER (WHERE percentual_alfabetizado IS NULL) AS b,
               COUNT(*) FILTER (WHERE meta_percentual IS NULL) AS c FROM silver)"""),
    "dq_orphans": with_silver("""
SELECT 'validacao_chave_relacionamento' AS check_name, COUNT(*) = 0 AS passed, COUNT(*) AS orfaos
FROM orphans""", ORPHANS),
    "dq_range": """
SELECT 'consistencia_pct_preco' AS check_name, COUNT(*) FILTER (WHERE x < -0.000001 OR x > 100.000001) = 0 AS passed,
       COUNT(*) FILTER (WHERE x < -0.000001 OR x > 100.000001) AS invalidos
FROM (SELECT l_extendedprice / 1000.0 AS x FROM lineitem) p""",
    "dq_report": with_silver(f"""
SELECT 'verificacao_duplicidade' AS check_name, dup = 0 AS passed, true AS critical,
       CASE WHEN dup = 0 THEN 'pass' ELSE 'fail' END AS status FROM agg
UNION ALL SELECT 'deteccao_valores_ausentes', ok, false, CASE WHEN ok THEN 'pass' ELSE 'warn' END
  FROM (SELECT {_pct('n0')} <= 5.0 AND {_pct('n1')} <= 5.0 AS ok FROM agg) m
UNION ALL SELECT 'consistencia_percentual_alfabetizado', bad = 0, true,
       CASE WHEN bad = 0 THEN 'pass' ELSE 'fail' END FROM agg
UNION ALL SELECT 'validacao_chave_relacionamento', n = 0, true, CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END
  FROM (SELECT COUNT(*) AS n FROM orphans) o""", """
per_key AS (
  SELECT id_municipio, ano, COUNT(*) AS n,
         COUNT(*) FILTER (WHERE proficiencia_media IS NULL) AS n0,
         COUNT(*) FILTER (WHERE percentual_alfabetizado IS NULL) AS n1,
         COUNT(*) FILTER (WHERE percentual_alfabetizado < -0.000001 OR percentual_alfabetizado > 100.000001) AS bad
  FROM silver GROUP BY id_municipio, ano),
agg AS (SELECT SUM(n) AS t, SUM(n) - COUNT(*) AS dup, SUM(n0) AS n0, SUM(n1) AS n1, SUM(bad) AS bad FROM per_key)""",
        ORPHANS),
    "kpi_coverage": with_silver_all("""
SELECT COUNT(DISTINCT id_municipio) AS total_municipios, MIN(ano) AS primeiro_ano, MAX(ano) AS ultimo_ano,
       CAST(MIN(ano) AS VARCHAR) || '–' || CAST(MAX(ano) AS VARCHAR) AS anos_cobertos
FROM silver"""),
    "kpi_coverage_from_sets": with_silver_all("""
SELECT s.ano, COUNT(DISTINCT s.id_municipio) AS municipios,
       COUNT(DISTINCT CASE WHEN EXISTS (SELECT 1 FROM silver b WHERE b.ano = s.ano - 1 AND b.id_municipio = s.id_municipio)
             THEN s.id_municipio END) AS tambem_no_anterior,
       (SELECT COUNT(DISTINCT id_municipio) FROM silver) AS total_municipios
FROM silver s GROUP BY s.ano"""),
    "kpi_national_mean": with_silver_all(f"""
SELECT MAX(ano) AS ultimo_ano, {exact_mean('percentual_alfabetizado', 4)} AS percentual_medio_nacional,
       AVG(proficiencia_media) AS proficiencia_media_nacional
FROM silver WHERE ano = (SELECT MAX(ano) FROM silver)"""),
    "kpi_hit_share": with_silver_all("""
SELECT MAX(ano) AS ultimo_ano, 100.0 * AVG(CAST(atingiu_meta AS INTEGER)) AS pct_municipios_atingiu_meta
FROM gold_goal WHERE ano = (SELECT MAX(ano) FROM gold_goal)""", GOLD_GOAL),
    "kpi_summary": with_silver_all(f"""
SELECT COUNT(DISTINCT id_municipio) AS total_municipios,
       CAST(MIN(ano) AS VARCHAR) || '–' || CAST(MAX(ano) AS VARCHAR) AS anos_cobertos,
       {exact_mean('CASE WHEN ano = (SELECT MAX(ano) FROM silver) THEN percentual_alfabetizado END', 4)}
         AS percentual_medio_nacional,
       AVG(CASE WHEN ano = (SELECT MAX(ano) FROM silver) THEN proficiencia_media END) AS proficiencia_media_nacional,
       100.0 * AVG(CASE WHEN ano = (SELECT MAX(ano) FROM silver)
                        THEN CAST(COALESCE(percentual_alfabetizado - meta_percentual >= 0, false) AS INTEGER) END)
         AS pct_municipios_atingiu_meta,
       MAX(ano) AS ultimo_ano
FROM silver"""),
    "kpi_region_vs_mean": with_silver_all(f"""
SELECT sigla_uf, nome_uf, ano, percentual_alfabetizado_medio,
       (SELECT {exact_mean('percentual_alfabetizado_medio', 2)} FROM now) AS media_nacional,
       COALESCE(percentual_alfabetizado_medio >= (SELECT {exact_mean('percentual_alfabetizado_medio', 2)} FROM now),
                false) AS acima_media
FROM now ORDER BY percentual_alfabetizado_medio ASC NULLS LAST, sigla_uf ASC NULLS LAST""", GOLD_REGION, """
now AS (SELECT * FROM gold_region WHERE ano = (SELECT MAX(ano) FROM gold_region))"""),
    "kpi_national_evolution": with_silver_all(f"""
SELECT ano, {exact_mean('percentual_alfabetizado_medio', 2)} AS percentual_alfabetizado_medio
FROM gold_region GROUP BY ano ORDER BY ano""", GOLD_REGION),
    "kpi_distribution": with_silver_all(f"""
SELECT g.bin, {_edge('g.bin - 1')} AS bin_start, {_edge('g.bin')} AS bin_end,
       CAST(COALESCE(c.n, 0) AS BIGINT) AS count, mean
FROM grid g LEFT JOIN counts c ON g.bin = c.bin CROSS JOIN edges""", f"""
vals AS (SELECT percentual_alfabetizado AS v FROM silver
         WHERE ano = (SELECT MAX(ano) FROM silver) AND percentual_alfabetizado IS NOT NULL),
bounds AS (SELECT MIN(v) AS lo, MAX(v) AS hi, {exact_mean('v', 4)} AS mean FROM vals),
edges AS (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo_e,
                 CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi_e, mean FROM bounds),
i0 AS (SELECT v, lo_e, hi_e,
              LEAST(CAST(FLOOR((v - lo_e) * (CAST(24 AS DOUBLE) / (hi_e - lo_e))) AS INTEGER), 23) AS i
       FROM vals CROSS JOIN edges),
i1 AS (SELECT v, lo_e, hi_e, CASE WHEN v < {_edge('i')} THEN i - 1 ELSE i END AS i FROM i0),
i2 AS (SELECT CASE WHEN v >= {_edge('i + 1')} AND i <> 23 THEN i + 1 ELSE i END + 1 AS bin FROM i1),
counts AS (SELECT bin, COUNT(*) AS n FROM i2 GROUP BY bin),
grid AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 25))"""),
    "kpi_worst_gap_topk": with_silver_all("""
SELECT id_municipio, nome_municipio, sigla_uf, ano, gap_para_meta,
       COALESCE(nome_municipio, id_municipio) || ' (' || sigla_uf || ')' AS rotulo
FROM gold_goal
WHERE ano = (SELECT MAX(ano) FROM gold_goal) AND gap_para_meta IS NOT NULL
ORDER BY gap_para_meta, id_municipio LIMIT 10""", GOLD_GOAL),
    "stream_ingest_bronze": """
SELECT event_type, COUNT(*) AS events, COUNT(DISTINCT user_id) AS users, ROUND(SUM(value), 2) AS value_sum
FROM events GROUP BY event_type""",
    "stream_quarantine": """
SELECT '{"event_id": ' || CAST(event_id AS VARCHAR) || ', broken' AS _raw FROM events WHERE event_type = 'error'""",
    "stream_rerun_idempotent": """
SELECT 1 AS run, COUNT(*) FILTER (WHERE ts < TIMESTAMP '2024-01-16') AS rows FROM events
UNION ALL SELECT 2, COUNT(*) FROM events
UNION ALL SELECT 3, COUNT(*) FROM events""",
    "quality_gate_run": f"""
WITH full_dim AS ({DIMENSION_ALL}), reg_dim AS ({DIMENSION}),
ids AS (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS id_municipio FROM lineitem),
o AS (SELECT COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM full_dim d WHERE d.id_municipio = ids.id_municipio)) AS n_all,
             COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM reg_dim d WHERE d.id_municipio = ids.id_municipio)) AS n_reg
      FROM ids)
SELECT 'all_suppliers' AS scenario, n_all = 0 AS gate_passed, n_all = 0 AS gold_written,
       CASE WHEN n_all = 0 THEN '' ELSE 'validacao_chave_relacionamento' END AS failed_checks FROM o
UNION ALL
SELECT 'registered_suppliers', n_reg = 0, n_reg = 0,
       CASE WHEN n_reg = 0 THEN '' ELSE 'validacao_chave_relacionamento' END FROM o""",
    "run_metrics": with_silver_all(f"""
SELECT 'ingest_batch_indicador' AS job, 'bronze' AS layer, COUNT(*) AS rows_processed FROM ({INDICATOR}) a
UNION ALL SELECT 'ingest_batch_municipio', 'bronze', COUNT(*) FROM ({DIMENSION_ALL}) b
UNION ALL SELECT 'ingest_batch_meta_municipio', 'bronze', COUNT(*) FROM ({GOALS_WIDE}) c
UNION ALL SELECT 'transform_silver', 'silver', COUNT(*) FROM silver
UNION ALL SELECT 'build_gold_indicador_por_municipio', 'gold', COUNT(*) FROM silver
UNION ALL SELECT 'build_gold_meta_vs_resultado', 'gold', COUNT(*) FROM silver
UNION ALL SELECT 'build_gold_evolucao_temporal_uf', 'gold', COUNT(*)
  FROM (SELECT DISTINCT sigla_uf, nome_uf, ano FROM silver) g
UNION ALL SELECT 'ingest_streaming', 'bronze', COUNT(*) FROM events"""),
    "bronze_type_change": f"""
SELECT id_municipio, NULL AS nome_uf, DATE '2024-01-01' AS dt_ingestao, 0 AS failed_checks FROM ({DIMENSION_ALL}) a
UNION ALL SELECT id_municipio, nome_uf, DATE '2024-01-02', 0 FROM ({DIMENSION_ALL}) b""",
    "silver_latest_snapshot_new_column": with_silver("SELECT * FROM goals_long"),
    "bronze_snapshot_content": f"""
SELECT COALESCE(i.id_municipio, m.id_municipio) AS id_municipio, ano, proficiencia_media, percentual_alfabetizado,
       nome, sigla_uf, nome_uf
FROM ({INDICATOR}) i FULL JOIN ({DIMENSION_ALL}) m ON i.id_municipio = m.id_municipio""",
    "gold_marts_content": with_silver_all(_marts_content(), GOLD_GOAL, GOLD_REGION),
    "goals_union_of_sources": GOALS_WIDE,
    "kpi_mean_many_decimals": """
WITH r AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, l_quantity AS q,
                  CASE WHEN l_linenumber <> 7 THEN l_extendedprice * (1.0::DOUBLE - l_discount) / 7e4::DOUBLE END AS x
           FROM lineitem)
SELECT MAX(ano) AS ultimo_ano, ROUND(AVG(x), 6) AS percentual_medio_nacional,
       ROUND(AVG(q), 6) AS proficiencia_media_nacional
FROM r WHERE ano = (SELECT MAX(ano) FROM r)""",
    "stream_malformed_variants": """
SELECT 'bronze' AS layer, 'event' AS kind, COUNT(*) AS rows FROM events
UNION ALL SELECT 'quarantine', k, COUNT(*) * n
  FROM events, (VALUES ('trailing', 1), ('twice', 1), ('list', 1), ('cut', 1), ('blank', 2)) x(k, n) GROUP BY k, n""",
    "stream_count_bound": """
WITH w AS (SELECT COUNT(*) FILTER (WHERE ts < TIMESTAMP '2024-01-16') AS a, COUNT(*) AS n FROM events),
r AS (SELECT 1 AS run, a AS rows, CAST(ceil(a / 500) AS BIGINT) AS batches, least(a, 500) AS largest FROM w
      UNION ALL SELECT 2, a, CAST(ceil(a / 500) AS BIGINT), least(a, 500) FROM w
      UNION ALL SELECT 3, n, CAST(ceil(a / 500) + ceil((n - a) / 500) AS BIGINT), greatest(least(a, 500), least(n - a, 500)) FROM w)
SELECT run, rows, batches, largest FROM r""",
    "stream_nested_events": """
SELECT event_id, user_id, event_type, value * 2 AS twice, true AS actor_is_no_number,
       3 * (SELECT COUNT(*) FROM events) AS quarantined FROM events""",
    "stream_metrics_by_batch": """
WITH n AS (SELECT COUNT(*) AS n, CAST(ceil(COUNT(*) / 700) AS BIGINT) AS b FROM events)
SELECT 'killed in the third batch' AS run, least(b, 2) AS records, least(b, 2) AS batches, least(n, 1400) AS rows FROM n
UNION ALL SELECT 'run again', b, b, n FROM n""",
    "stream_two_checkpoints": "SELECT event_id, event_type FROM events",
    "stream_many_batches": "SELECT COUNT(*) AS counted, COUNT(*) AS stored, true AS over_100_batches FROM events",
    "pipeline_from_microdata": with_silver_all("SELECT * FROM gold_goal", GOLD_GOAL),
}
ORACLE["kpi_summary_from_gold"] = ORACLE["kpi_summary"]
