from tripmart.functions.expressions import (
    SURROGATE_NULL, avg_speed_mph, duration_minutes, ingestion_time, month_bounds, ntz,
    pickup_date, safe_divide, surrogate_key, whole_units, year_month,
)

__all__ = ["SURROGATE_NULL", "avg_speed_mph", "duration_minutes", "ingestion_time", "month_bounds", "ntz",
           "pickup_date", "safe_divide", "surrogate_key", "whole_units", "year_month"]
