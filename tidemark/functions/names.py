"""Column and table names of the surveyed star schema, for users with queries on those names."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Our table name and the surveyed one.
TABLE_NAMES = {
    "dim_entity": "dim_municipio",
    "dim_period": "dim_tempo",
    "fact_entity": "fact_indicadores_municipio",
    "fact_group": "fact_indicadores_uf",
    "fact_nation": "fact_indicadores_brasil",
}

# Our column name and the surveyed one, in all tables.
COLUMN_NAMES = {
    "entity_key": "sk_municipio",
    "period_key": "sk_tempo",
    "entity_code": "codigo_municipio",
    "entity_name": "nome_municipio",
    "group_code": "codigo_uf",
    "group_short": "sigla_uf",
    "group_name": "nome_uf",
    "region_code": "codigo_regiao",
    "region_name": "nome_regiao",
    "region_short": "sigla_regiao",
    "period": "ano",
    "half": "semestre",
    "quarter": "trimestre",
    "entities": "qtd_municipios",
    "groups": "qtd_ufs",
    "total": "pib_total",
    "rate": "pib_per_capita",
    "mean_rate": "pib_per_capita_medio",
    "growth_total": "yoy_pib",
    "growth_measure": "yoy_populacao",
    "share_in_group": "share_pib_uf",
    "share_in_nation": "share_pib_brasil",
    "rank_in_group": "rank_pib_uf",
    "rank_in_nation": "rank_pib_brasil",
    "value": "valor",
    "variable": "variavel",
    "source": "fonte",
    "level": "nivel_territorial",
    "series_code": "serie_codigo",
    "series_name": "serie_nome",
    "date_text": "data",
    "obs_date": "data_parsed",
    "year": "ano",
    "month": "mes",
    "processed_at": "dt_processamento",
    "load_date": "dt_carga",
}

# Names that differ by table, and the ending of a series mean.
MEASURE_NAMES = {"silver": "populacao", "gold": "populacao_total"}
SERIES_VALUES = {"value_text": "valor", "value": "valor_decimal"}
MEAN_ENDING = ("_mean", "_medio")


def surveyed_names(columns: list[str], layer: str) -> dict[str, str]:
    """Our name and the surveyed one of each column of a table of the given layer."""
    names = dict(COLUMN_NAMES)
    names["measure"] = MEASURE_NAMES.get(layer, "populacao")
    if "value_text" in columns:
        names |= SERIES_VALUES
    ours, theirs = MEAN_ENDING
    names |= {c: c.removesuffix(ours) + theirs for c in columns if c.endswith(ours)}
    return {c: names[c] for c in columns if c in names}


def with_surveyed_names(df: DataFrame, layer: str) -> DataFrame:
    """Rename the columns of a table of the given layer."""
    return df.withColumnsRenamed(surveyed_names(df.columns, layer))
