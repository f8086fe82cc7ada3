"""Portfolio overlap, look-through, holder networks and flows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.work import checkpointed


def overlap(fund: DataFrame, benchmark: DataFrame, key: str = "series_id", item: str = "cusip", weight: str = "w") -> DataFrame:
    """One row per fund against one benchmark (item, weight): active share, overlap, jaccard and counts.

    Weights are fractions and are not renormalised. Items only in the benchmark are its totals less the common part, so the
    benchmark is never joined in full to each fund.
    """
    f = fund.groupBy(key, item).agg(F.sum(weight).alias("wf"))
    b = benchmark.groupBy(item).agg(F.sum(weight).alias("wb"))
    total = b.agg(F.sum("wb").alias("cb"), F.sum(F.abs("wb")).alias("ab"), F.count("*").alias("nb"))
    m = f.join(b, item, "left").groupBy(key).agg(
        F.sum("wf").alias("cf"), F.count("*").alias("nf"), F.count("wb").alias("nc"), F.sum(F.abs(F.col("wf") - F.coalesce("wb", F.lit(0.0)))).alias("ad"),
        F.coalesce(F.sum(F.abs("wb")), F.lit(0.0)).alias("common_b"), F.coalesce(F.sum(F.when(F.col("wb").isNotNull(), F.least("wf", "wb"))), F.lit(0.0)).alias("overlap"),
    ).crossJoin(F.broadcast(total))
    den = F.least("cf", "cb")
    active = 0.5 * (F.col("ad") + F.col("ab") - F.col("common_b"))
    return m.select(
        key, F.when(den > 0, active / den).alias("active_share"), F.when(den > 0, F.col("overlap") / den).alias("overlap_share"), F.col("overlap").alias("overlap_raw"), F.col("cf").alias("fund_coverage"), F.col("cb").alias("benchmark_coverage"),
        F.col("nf").alias("n_fund"), F.col("nb").alias("n_benchmark"), F.col("nc").alias("n_common"), (F.col("nc") / (F.col("nf") + F.col("nb") - F.col("nc"))).alias("jaccard"),
    )


def look_through(holdings: DataFrame, edges: DataFrame, depth: int | None = 2) -> DataFrame:
    """Leaves (root, level, pct, gross, paths, child, report_date and the holding's own columns) after expanding funds held by funds.

    holdings: (series_id, report_date, cusip, pct, ...), latest report per series. edges: (cusip, child). A holding whose
    child has holdings, is no ancestor and lies above ``depth`` (None: at any level) is replaced by the child's holdings at
    the compounded weight. The ancestors of a level are the root and the funds walked before it, not the fund walked at it.
    Rows without a weight are left out.

    The holdings are read once. A frontier of (root, fund, ancestors) goes down level by level, until none of its funds
    holds another one to expand: it meets only the rows that can be expanded, few among all, and ways that lead to the same
    fund over the same ancestors are one from there on. A leaf is a holding of a fund of the frontier: paths says by how
    many ways it was reached, pct is their sum and gross that of their sizes.
    """
    holdings = holdings.where("pct IS NOT NULL")
    known = holdings.select(F.col("series_id").alias("child")).distinct().withColumn("has", F.lit(True))
    cols = [c for c in holdings.columns if c not in ("series_id", "pct")]
    tagged = holdings.join(edges, "cusip", "left").join(known, "child", "left")
    tagged = checkpointed(tagged.select(F.col("series_id").alias("walked"), *cols, F.col("pct").alias("raw"), "child", F.coalesce("has", F.lit(False)).alias("has")))
    # Few rows hold a fund, so these are their own small table.
    funds = checkpointed(tagged.where("has").groupBy("walked", "child").agg(F.sum("raw").alias("raw"), F.sum(F.abs("raw")).alias("size"), F.count("*").alias("ways")))
    own = F.array("walked").alias("ancestors")
    frontier = tagged.select("walked").distinct().select(F.col("walked").alias("root"), "walked", own, F.lit(1.0).alias("weight"), F.lit(1.0).alias("size"), F.lit(1).cast("bigint").alias("paths"))
    leaves, level = None, 0
    while True:
        last = depth is not None and level == depth
        opens = F.col("has") & ~F.array_contains("ancestors", F.coalesce("child", F.lit(""))) & F.lit(not last)
        below = tagged.withColumns({"root": F.col("walked"), "ancestors": own, "weight": F.lit(1.0), "size": F.lit(1.0), "paths": F.lit(1).cast("bigint")}) if level == 0 else frontier.join(tagged, "walked")
        pct, gross = F.col("raw") * F.col("weight"), F.abs("raw") * F.col("size")
        done = below.where(~opens).select("root", F.lit(level).alias("level"), pct.alias("pct"), gross.alias("gross"), "paths", "child", *cols)
        leaves = done if leaves is None else leaves.unionByName(done)
        if last:
            return leaves
        f = funds.withColumnsRenamed({"raw": "_raw", "size": "_size"})
        deeper = frontier.join(f, "walked").where(~F.array_contains("ancestors", F.col("child")))
        deeper = deeper.select("root", F.col("child").alias("walked"), F.array_sort(F.array_union("ancestors", F.array("walked"))).alias("ancestors"), (F.col("weight") * F.col("_raw") / 100).alias("weight"), (F.col("size") * F.col("_size") / 100).alias("size"), (F.col("paths") * F.col("ways")).alias("paths"))
        frontier = checkpointed(deeper.groupBy("root", "walked", "ancestors").agg(*(F.sum(c).alias(c) for c in ("weight", "size", "paths"))))
        if frontier.isEmpty():
            return leaves
        level += 1


def exposures(leaves: DataFrame, dimensions: list[str]) -> DataFrame:
    """(root, dimension, key, direct, indirect) percentages; a missing key is UNKNOWN."""
    each = leaves.select("root", "level", "pct", F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.coalesce(d, F.lit("UNKNOWN")).alias("key")) for d in dimensions))).alias("d")).select("root", "level", "pct", "d.*")
    side = lambda ok: F.sum(F.when(ok, F.col("pct")).otherwise(0.0))
    return each.groupBy("root", "dimension", "key").agg(side(F.col("level") == 0).alias("direct"), side(F.col("level") > 0).alias("indirect"))


def residuals(leaves: DataFrame, derivative: list[str]) -> DataFrame:
    """Per root: what could not be decomposed, derivatives gross and net, the oldest report in the chain."""
    is_derivative = F.col("asset_class").isin(derivative)
    return leaves.groupBy("root").agg(
        F.sum(F.when(F.col("child").isNotNull(), F.col("gross")).otherwise(0.0)).alias("nondecomposable"), F.sum(F.when(is_derivative, F.col("gross")).otherwise(0.0)).alias("derivatives_gross"),
        F.sum(F.when(is_derivative, F.col("pct")).otherwise(0.0)).alias("derivatives_net"), F.sum("pct").alias("total"), F.min("report_date").alias("oldest"), F.sum("paths").alias("n"),
    )


def period_changes(df: DataFrame, keys: list[str], period: str, value: str) -> DataFrame:
    """Latest two periods per first key: value now and before per keys, and their difference."""
    rank = F.dense_rank().over(Window.partitionBy(keys[0]).orderBy(F.desc(period)))
    last = df.withColumn("_k", rank).where("_k <= 2")
    return last.groupBy(*keys).agg(*(F.coalesce(F.sum(F.when(F.col("_k") == k, F.col(value))), F.lit(0.0)).alias(n) for k, n in ((1, "now"), (2, "before")))).withColumn("change", F.col("now") - F.col("before"))


def top_rows(df: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def holder_network(df: DataFrame, n_items: int = 12, n_holders: int = 8) -> DataFrame:
    """Edges (cik, cusip, value) between the largest holders and the most held items."""
    items = df.groupBy("cusip").agg(F.sum("value_usd").alias("v")).orderBy(F.desc("v"), "cusip").limit(n_items).select("cusip")
    holders = df.groupBy("cik").agg(F.sum("value_usd").alias("v")).orderBy(F.desc("v"), "cik").limit(n_holders).select("cik")
    return df.join(F.broadcast(items), "cusip").join(F.broadcast(holders), "cik").groupBy("cik", "cusip").agg(F.sum("value_usd").alias("value"))


def monthly_flows(reports: DataFrame, months: int = 3) -> DataFrame:
    """Unpivot sales_1..n and redemption_1..n of a report: a row per month, ending with the report's own."""
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("ordinal"), F.col(f"sales_{k}").alias("sales"), F.col(f"redemption_{k}").alias("redemption")) for k in range(1, months + 1)))).alias("m")
    df = reports.select("series_id", "report_date", "net_assets", each).select("series_id", "report_date", "net_assets", "m.*")
    month = F.last_day(F.add_months("report_date", F.col("ordinal") - months))
    net = F.coalesce("sales", F.lit(0.0)) - F.coalesce("redemption", F.lit(0.0))
    return df.select("series_id", month.alias("month_end"), "ordinal", "sales", "redemption", net.alias("net"), F.try_divide(net, "net_assets").alias("share"))


def universe_features(universe: DataFrame, stage: DataFrame, identity: DataFrame, proxies: DataFrame) -> DataFrame:
    """A row per instrument of the universe: the newest staged strategy label (of one date the last by name), else its own
    strategy, else 'unclassified'; identity without leading zeros, and the label's benchmark, where there are any."""
    newest = stage.groupBy("instrument_id").agg(F.max_by("strategy_label", F.struct("effective_date", "strategy_label")).alias("_newest"))
    label = F.coalesce(F.nullif("_newest", F.lit("")), F.nullif("strategy", F.lit("")), F.lit("unclassified"))
    df = universe.join(newest, "instrument_id", "left").withColumn("strategy_label", label).join(identity, "instrument_id", "left").join(proxies, "strategy_label", "left")
    return df.select("instrument_id", "ticker", "asset_class", "is_active", "strategy_label", F.ltrim("cik", F.lit("0")).alias("cik_unpadded"), "sec_series_id", "benchmark_ticker")
