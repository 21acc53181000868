"""Wholesale-cost recovery per SKU: cumulative revenue over unit cost by months since available.

sku_month_revenue   monthly SKU revenue joined to products, replenishment marker
sku_cohort          SKU x months-since-available revenue, non-replenishment styles only
wcr                 cumulative revenue and return on wholesale cost

The analysis accumulates with a triangular self-join (``a.m <= a1.m`` within a
SKU), quadratic in months per SKU; here it is one RANGE window per SKU.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import month_boundaries
from ..operators.aggs import cumulative

# Fixed values of the analysis (the second spelling is as written there).
RESERVE_ORDER_TYPES = ("CLASSIC_POSH", "STORE_PICKUP", "CLASSIC", "STORE_PICKUPWEB")


def replenishment_styles(master_replenish_style: DataFrame, products_master: DataFrame) -> DataFrame:
    return (master_replenish_style.select(F.col("style").alias("replenishment_style"))
            .union(products_master.filter(F.col("is_replenishment_style") == 1)
                   .select(F.col("model").alias("replenishment_style")))
            .distinct())


REVENUE_COLS = ["fiscal_year_rbd", "fiscal_month_rbd", "fiscal_month_start_rbd", "fiscal_year_avl", "fiscal_month_avl",
                "fiscal_month_start_avl", "style", "sku", "cost", "order_type", "current_total_units", "total_booking",
                "product_total_sku", "queue_subscription_revenue_sku", "queue_ttb_revenue_sku",
                "queue_monthly_athome_days_sku"]
#: Of the product columns of the analysis, those a products table may have; the ones it has are taken.
PRODUCT_COLS = ["designer", "title", "sub_type", "high_level_shape", "detailed_formality", "designer_classification",
                "season_code", "style_out"]


def sku_month_revenue(fact: DataFrame, products: DataFrame, repl: DataFrame, min_avl_year: int = 2009) -> DataFrame:
    """Monthly SKU fact with the columns of its product and the replenishment marker (the style, or null).

    An inner join, so a style with several product rows is repeated as often; ``repl`` holds each
    style once.
    """
    p = products.select(F.col("style").alias("_ps"), *[c for c in PRODUCT_COLS if c in products.columns])
    x = (fact.filter(F.col("fiscal_year_avl") >= min_avl_year).join(p, fact["style"] == p["_ps"], "inner")
         .join(repl, fact["style"] == repl["replenishment_style"], "left"))
    return x.select(*[c for c in REVENUE_COLS if c in fact.columns], *p.columns[1:], "replenishment_style")


def sku_cohort(revenue: DataFrame, avl_years) -> DataFrame:
    """Revenue per SKU x rental fiscal month x months since available, non-replenishment only."""
    x = revenue.filter(F.col("fiscal_year_avl").isin(list(avl_years)) & F.col("replenishment_style").isNull())
    msa = month_boundaries(F.make_date("fiscal_year_avl", "fiscal_month_avl", F.lit(1)),
                           F.make_date(F.year("fiscal_month_start_rbd"), F.col("fiscal_month_rbd"), F.lit(1)))
    return (x.groupBy("fiscal_year_avl", "sku",
                      F.col("fiscal_month_start_rbd").alias("fiscal_month_start"),
                      msa.cast("bigint").alias("month_since_available"),
                      F.col("current_total_units").alias("unit_count"),
                      (F.col("cost") * F.col("current_total_units")).cast("decimal(38,2)").alias("wholesale_cost"))
            .agg(F.sum("product_total_sku").cast("decimal(38,2)").alias("rev_reserve"),
                 F.sum("queue_subscription_revenue_sku").cast("decimal(38,4)").alias("rev_subscription"),
                 F.sum("queue_ttb_revenue_sku").cast("decimal(38,4)").alias("rev_liquidation"),
                 F.sum(F.when(F.col("order_type").isin(*RESERVE_ORDER_TYPES), F.col("total_booking")))
                 .cast("bigint").alias("order_reserve"),
                 F.sum("queue_monthly_athome_days_sku").cast("decimal(38,2)").alias("subscription_athome_days")))


def wcr(cohort: DataFrame) -> DataFrame:
    """Running revenue per SKU over months since available and its return on cost."""
    x = cohort.filter(F.col("sku").isNotNull() & F.col("month_since_available").isNotNull())
    rev = F.col("rev_reserve") + F.col("rev_subscription") + F.col("rev_liquidation")
    x = cumulative(x, "sku", "month_since_available", rev, "_run")
    return x.select(*cohort.columns,
                    F.col("_run").cast("decimal(38,4)").alias("rev_running_total"),
                    (F.col("_run").cast("double") / (F.col("wholesale_cost").cast("double") + 0.01) - 1)
                    .alias("wcr_pct"))
