"""Domain views over the star-schema test tables.

Each view is one SELECT that Spark and DuckDB both accept; braces name the tables and views it reads. ``view`` gives it as
a DataFrame, ``oracle`` puts it before a DuckDB statement, so both sides of a comparison see the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    # Entity series: a level per supplier and day.
    "nav": """SELECT CAST(l_suppkey AS STRING) AS instrument_id, d AS nav_date,
        round(100 * exp(0.2 * sum(x) OVER (PARTITION BY l_suppkey ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 6) AS nav, aum
        FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, round(avg(l_discount) - 0.05, 9) AS x, 1000000 + round(sum(l_extendedprice), 2) AS aum
              FROM {lineitem} GROUP BY l_suppkey, CAST(l_shipdate AS DATE)) t""",
    "bench": """SELECT d AS nav_date, round(100 * exp(2.0 * sum(x) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 6) AS nav
        FROM (SELECT CAST(l_shipdate AS DATE) AS d, round(avg(l_discount) - 0.05, 9) AS x FROM {lineitem} GROUP BY CAST(l_shipdate AS DATE)) t""",
    "cohort": """SELECT CAST(s_suppkey AS STRING) AS instrument_id, n_name AS label, r_name AS asset_class, s_acctbal AS size
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    # Returns with moves beyond one half rejected; rn counts the surviving rows from the newest.
    "ret": """SELECT instrument_id, nav_date, nav, aum, r, row_number() OVER (PARTITION BY instrument_id ORDER BY nav_date DESC) AS rn
        FROM (SELECT *, nav / lag(nav) OVER (PARTITION BY instrument_id ORDER BY nav_date) - 1 AS r FROM {nav}) t WHERE abs(r) <= 0.5""",
    "bret": "SELECT nav_date, b FROM (SELECT nav_date, nav / lag(nav) OVER (ORDER BY nav_date) - 1 AS b FROM {bench}) t WHERE abs(b) <= 0.5",
    "prices": """SELECT CAST(l_partkey AS STRING) AS ticker, CAST(l_shipdate AS DATE) AS date, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / sum(l_quantity) / 103.19e0 AS close, sum(l_quantity) AS volume
        FROM {lineitem} GROUP BY l_partkey, CAST(l_shipdate AS DATE)""",
    # Macro series and their revisions.
    "macro": """SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS obs_date, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / count(*) / 5.1719e6 AS value
        FROM {orders} GROUP BY o_orderpriority, CAST(o_orderdate AS DATE)""",
    "monthly": """SELECT o_orderpriority AS series_id, CAST(date_trunc('MONTH', o_orderdate) AS DATE) AS obs_date, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / count(*) / 5.1719e6 AS value
        FROM {orders} GROUP BY o_orderpriority, CAST(date_trunc('MONTH', o_orderdate) AS DATE)""",
    "vintages": """SELECT series_id, observation_period, vintage_date, CAST(vintage_date AS TIMESTAMP) AS available_at, value,
        row_number() OVER (PARTITION BY series_id, observation_period ORDER BY vintage_date) - 1 AS revision_number
        FROM (SELECT series_id, observation_period, vintage_date, CAST(sum(v) OVER (PARTITION BY series_id, observation_period ORDER BY vintage_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 1e5 AS value
            FROM (SELECT o_orderpriority AS series_id, CAST(date_trunc('MONTH', o_orderdate) AS DATE) AS observation_period,
                    greatest(last_day(CAST(l_shipdate AS DATE)), last_day(CAST(o_orderdate AS DATE))) AS vintage_date, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS v
                  FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey
                  GROUP BY o_orderpriority, CAST(date_trunc('MONTH', o_orderdate) AS DATE), greatest(last_day(CAST(l_shipdate AS DATE)), last_day(CAST(o_orderdate AS DATE)))) a) b""",
    "ticks": "SELECT event_id, CAST(user_id AS STRING) AS symbol, event_type AS series_id, ts, value AS price FROM {events}",
    "short_vintages": """SELECT series_id, observation_period, available_at, value, row_number() OVER (PARTITION BY series_id, observation_period ORDER BY available_at, event_id) - 1 AS revision_number
        FROM (SELECT event_type AS series_id, CAST(ts AS DATE) AS observation_period, ts AS available_at, event_id, round(value, 6) AS value FROM {events}) t""",
    # Filed facts, holdings, flows, owners.
    "facts": """SELECT o_custkey AS cik, o_orderpriority AS concept, last_day(CAST(o_orderdate AS DATE)) AS period_end, CAST(o_orderdate AS DATE) AS filed, o_orderkey AS accn, o_totalprice AS val, o_orderstatus AS fp
        FROM {orders}""",
    "holdings": """SELECT CAST(l_suppkey AS STRING) AS series_id, report_date, CAST(l_partkey AS STRING) AS cusip, p_type AS asset_class, p_brand AS sector, market_value, qty,
        100 * market_value / sum(market_value) OVER (PARTITION BY l_suppkey, report_date) AS pct
        FROM (SELECT l_suppkey, last_day(add_months(CAST(date_trunc('QUARTER', l_shipdate) AS DATE), 2)) AS report_date, l_partkey, p_type, p_brand, round(sum(l_extendedprice), 2) AS market_value, sum(l_quantity) AS qty
              FROM {lineitem} JOIN {part} ON l_partkey = p_partkey GROUP BY l_suppkey, last_day(add_months(CAST(date_trunc('QUARTER', l_shipdate) AS DATE), 2)), l_partkey, p_type, p_brand) t""",
    "latest_holdings": """SELECT series_id, report_date, cusip, asset_class, sector, market_value, qty, pct
        FROM (SELECT h.*, max(CASE WHEN report_date <= DATE '1998-06-30' THEN report_date END) OVER (PARTITION BY series_id) AS newest FROM {holdings} h) t WHERE report_date = newest""",
    "inst": """SELECT CAST(c_nationkey AS STRING) AS cik, CAST(date_trunc('QUARTER', o_orderdate) AS DATE) AS period, CAST(l_partkey AS STRING) AS cusip, round(sum(l_extendedprice), 2) AS value_usd, sum(l_quantity) AS shares
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {lineitem} ON o_orderkey = l_orderkey GROUP BY c_nationkey, CAST(date_trunc('QUARTER', o_orderdate) AS DATE), l_partkey""",
    "flows": """SELECT CAST(l_suppkey AS STRING) AS series_id, last_day(CAST(l_shipdate AS DATE)) AS month_end,
        round(sum(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice ELSE 0 END), 2) AS sales, round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END), 2) AS redemption, round(sum(l_extendedprice) * 10, 2) AS net_assets
        FROM {lineitem} GROUP BY l_suppkey, last_day(CAST(l_shipdate AS DATE))""",
    "insider": """SELECT CAST(user_id AS STRING) AS issuer, CAST(ts AS DATE) AS transaction_date, CASE event_type WHEN 'purchase' THEN 'P' WHEN 'error' THEN 'S' ELSE 'M' END AS code, round(value, 2) AS value_usd FROM {events}""",
}

def _reads(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


def view(spark: SparkSession, sf_dir: str, name: str, **given: DataFrame) -> DataFrame:
    """A domain view, or a test table, as a DataFrame. Frames that are given stand for the tables and views of their names."""
    if name in given:
        return given[name]
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(VIEWS[name], **{n: view(spark, sf_dir, n, **given) for n in _reads(VIEWS[name])})


def _needs(name: str, found: list[str]) -> None:
    for n in _reads(VIEWS.get(name, "")):
        _needs(n, found)
    if name in VIEWS and name not in found:
        found.append(name)


def _duck(sql: str) -> str:
    """The few words DuckDB spells another way."""
    sql = re.sub(r"\{(\w+)\}", r"\1", sql)
    return re.sub(r"add_months\(((?:[^()]|\((?:[^()]|\([^()]*\))*\))*), (-?\d+)\)", r"CAST((\1) + to_months(\2) AS DATE)", sql)


def oracle(sql: str, *views: str) -> str:
    """DuckDB statement: the views it names (and what they read), then sql."""
    found: list[str] = []
    for name in views:
        _needs(name, found)
    parts = [f"{n} AS MATERIALIZED ({_duck(VIEWS[n])})" for n in found]
    sql = _duck(sql).strip()
    if not parts:
        return sql
    return f"WITH {', '.join(parts)}{', ' + sql[5:] if sql[:5].upper() == 'WITH ' else ' ' + sql}"
