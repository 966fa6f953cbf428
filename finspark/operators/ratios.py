"""T2 financial ratios and T3 portfolio analytics (row-local arithmetic + group share)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.functions.scalar import nan_to_null, safe_div
from finspark.session import staged

RATIO_COLUMNS = ["debt_to_equity", "current_ratio", "quick_ratio", "roa", "roe",
                 "profit_margin", "asset_turnover"]


def financial_ratios(df: DataFrame) -> DataFrame:
    """Ratios from statement columns; zero denominators give NULL, signs kept; NaN is missing.

    Current and quick ratio use the demo assumptions of the source system:
    current assets = 0.4 x total assets, quick assets = 0.3 x total assets,
    current liabilities = 0.3 x total liabilities.
    """
    df = nan_to_null(df)
    ta, tl = F.col("total_assets"), F.col("total_liabilities")
    se, ni, rev = F.col("shareholders_equity"), F.col("net_income"), F.col("revenue")
    hundred = F.lit(100.0)
    return df.withColumns({
        "debt_to_equity": safe_div(tl, se),
        "current_ratio": safe_div(ta * F.lit(0.4), tl * F.lit(0.3)),
        "quick_ratio": safe_div(ta * F.lit(0.3), tl * F.lit(0.3)),
        "roa": safe_div(ni, ta) * hundred,
        "roe": safe_div(ni, se) * hundred,
        "profit_margin": safe_div(ni, rev) * hundred,
        "asset_turnover": safe_div(rev, ta),
    })


def share_of_group(df: DataFrame, value: str, group: list[str], name: str) -> DataFrame:
    """Value / sum(value) over the group; NULL group key -> NULL share;
    a NaN value is missing: it has no share and adds nothing to the total.

    The input is written once (shared folder); totals and rows both come from
    there, so an expensive input (a join) is computed once.  The group total
    is a partial (map-side combined) aggregate joined back, not a window: a
    hot group is reduced before the shuffle, and the join is split by AQE's
    skew handling (or broadcast when the totals turn out small at run time).
    """
    df = staged(nan_to_null(df, [value, *group]), "share_of_group")
    totals = (df.where(reduce(lambda a, b: a & b, [F.col(g).isNotNull() for g in group]))
              .groupBy(*group).agg(F.sum(value).alias("_grp_total")))
    totals = totals.select(*[F.col(g).alias(f"_t_{g}") for g in group], "_grp_total")
    cond = reduce(lambda a, b: a & b, [F.col(g) == F.col(f"_t_{g}") for g in group])
    out = df.join(totals, cond, "left")
    return (out.withColumn(name, safe_div(F.col(value), F.col("_grp_total")))
            .drop("_grp_total", *[f"_t_{g}" for g in group]))


def portfolio_analytics(df: DataFrame, group=("portfolio_id", "position_date")) -> DataFrame:
    """Market value, unrealized P&L, weight within (portfolio, date), P&L %.  NaN is missing."""
    df = nan_to_null(df)
    q, px, cost = F.col("quantity"), F.col("current_price"), F.col("avg_cost")
    out = df.withColumns({
        "market_value": q * px,
        "unrealized_pnl": (px - cost) * q,
    })
    out = share_of_group(out, "market_value", list(group), "weight")
    return out.withColumn("pnl_percentage",
                          safe_div(F.col("unrealized_pnl"), cost * q) * F.lit(100.0))
