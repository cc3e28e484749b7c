"""KPI plans (M1-M10, A7) and the query catalog."""

from chargepulse.plans.notify import (
    daily_totals, minute_orders, province_hour_failures, top10_province, hourly_totals,
    notify_base, notify_report,
)
from chargepulse.plans.request import (
    top3_failure_province, province_minute, province_hour, request_base, request_report,
)
from chargepulse.plans.topup import (
    topup_daily_money, month_phone_avg, phone_mean_monthly, topup_base, topup_report,
)

__all__ = [
    "daily_totals", "minute_orders", "province_hour_failures", "top10_province", "hourly_totals",
    "notify_base", "notify_report", "top3_failure_province", "province_minute", "province_hour",
    "topup_daily_money", "month_phone_avg", "phone_mean_monthly", "request_base", "request_report",
    "topup_base", "topup_report",
]
