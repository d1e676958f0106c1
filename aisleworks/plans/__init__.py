from aisleworks.plans.daily import (
    kpi_agg, kpi_base, kpi_daily, week_out_of_stock_running, with_ratios,
)
from aisleworks.plans.market import kpi_by_market_category
from aisleworks.plans.restate import restate
from aisleworks.plans.weekly import kpi_weekly

__all__ = [
    "kpi_agg",
    "kpi_base",
    "kpi_by_market_category",
    "kpi_daily",
    "kpi_weekly",
    "restate",
    "week_out_of_stock_running",
    "with_ratios",
]
