"""Column-to-column functions over Spark built-ins; no Python UDF anywhere."""

from ledgerloom.functions.audit import audit_columns
from ledgerloom.functions.banding import (
    credit_band,
    dpd_bucket,
    income_band_sort,
    provision_rate,
    review_status,
    severity_rank,
    step_score,
)
from ledgerloom.functions.dates import (
    calendar_months,
    calendar_years,
    date_lit,
    date_part,
    days_between,
    is_business_day,
    month_key,
    partition_key,
    to_business_time,
    ts_lit,
    whole_hours,
)
from ledgerloom.functions.numeric import amount_when, money, money_sum, safe_divide, zero_if_null
from ledgerloom.functions.text import lower_trim, mask_pii, title_words, upper_trim

__all__ = [
    "amount_when",
    "audit_columns",
    "calendar_months",
    "calendar_years",
    "credit_band",
    "date_lit",
    "date_part",
    "days_between",
    "dpd_bucket",
    "income_band_sort",
    "is_business_day",
    "lower_trim",
    "mask_pii",
    "money",
    "money_sum",
    "month_key",
    "partition_key",
    "provision_rate",
    "review_status",
    "safe_divide",
    "severity_rank",
    "step_score",
    "title_words",
    "to_business_time",
    "ts_lit",
    "upper_trim",
    "whole_hours",
    "zero_if_null",
]
