from tickloom.functions.scalars import (
    epoch_seconds_between,
    micros,
    order_key,
    percent_change,
    range_percent,
    text_to_double,
    text_to_long,
    trade_date,
    trend,
)

__all__ = [
    "epoch_seconds_between", "micros", "order_key", "percent_change", "range_percent",
    "text_to_double", "text_to_long", "trade_date", "trend",
]
