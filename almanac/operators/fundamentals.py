"""Ratios of companies from what they filed, one filed period as a whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions.metrics import ratio
from almanac.operators.asof import asof_join

#: Larger ratios are taken for errors in what was filed.
BOUND = 100


def company_rows(periods: DataFrame, shares: DataFrame, company: str = "cik", period: str = "period_end") -> DataFrame:
    """periods (company, period, income, equity, assets, revenue, gross) with the shares that were newest at each period's end,
    and the assets of the newest period a year before it (null if that period has none: no older one is looked for)."""
    shares = shares.withColumnRenamed(period, "_since")
    before = periods.select(company, F.expr(f"{period} + INTERVAL 12 MONTH").cast("date").alias("_due"), F.col("assets").alias("assets_year_before"))
    rows = asof_join(periods, shares, [company], period, "_since", ["shares"])
    return asof_join(rows, before, [company], period, "_due", ["assets_year_before"])


def _bounded(x: Column) -> Column:
    return F.when(F.abs(x) <= BOUND, x)


def ratios(prices: DataFrame, companies: DataFrame, company: str, date: str, close: str, period: str = "period_end") -> DataFrame:
    """prices with cap, pe, roe, de, margin, roa, investment_growth, gross_profitability and the period they are of.

    Each price meets the company's newest row until its date, the whole row: values of different periods are never mixed,
    so what that period lacks is null. Denominators of zero or less, and shares of zero or less, give none.
    """
    names = ["income", "equity", "assets", "revenue", "gross", "shares", "assets_year_before", period]
    df = asof_join(prices, companies, [company], date, period, names)
    cap = F.when(F.col("shares") > 0, F.col("shares") * F.col(close))
    margin = ratio(F.col("gross"), F.col("revenue"))
    found = {
        "cap": cap, "pe": ratio(cap, F.col("income")), "roe": ratio(F.col("income"), F.col("equity")), "de": ratio(F.col("assets") - F.col("equity"), F.col("equity")), "margin": margin,
        "roa": _bounded(ratio(F.col("income"), F.col("assets"))), "investment_growth": _bounded(ratio(F.col("assets"), F.col("assets_year_before")) - 1), "gross_profitability": _bounded(margin),
    }
    return df.select(*prices.columns, *(c.alias(n) for n, c in found.items()), period)
