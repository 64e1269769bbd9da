"""Tax treatment read from a name, a category and a long-term flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers of exempt vehicles and the labels of the three regimes.
EXEMPT_MARKERS = ("INCENTIVAD", "INFRA")
EXEMPT = "isento_pf_incentivado"
LONG_TERM = "tabela_regressiva_longo_prazo"
ORDINARY = "tabela_regressiva"


def _exempt(name: Column, category: Column) -> Column:
    text = F.upper(
        F.concat(F.coalesce(name, F.lit("")), F.lit(" "), F.coalesce(category, F.lit("")))
    )
    found = F.lit(False)
    for marker in EXEMPT_MARKERS:
        found = found | text.contains(marker)
    return found


def tax_efficiency(name: Column, category: Column, long_term: Column) -> Column:
    return (
        F.when(_exempt(name, category), F.lit(1.0))
        .when(long_term == "S", F.lit(0.5))
        .otherwise(F.lit(0.0))
    )


def tax_regime(name: Column, category: Column, long_term: Column) -> Column:
    return (
        F.when(_exempt(name, category), F.lit(EXEMPT))
        .when(long_term == "S", F.lit(LONG_TERM))
        .otherwise(F.lit(ORDINARY))
    )
