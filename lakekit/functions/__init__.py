from lakekit.functions.columns import (
    MONEY,
    as_double,
    band,
    flag,
    legacy_int,
    lenient_double,
    load_date,
    amount,
    money,
    money_sum,
    money_total,
    pct,
    pick,
    safe_ratio,
    surrogate_id,
    typed_null,
)

__all__ = [
    "MONEY",
    "as_double",
    "band",
    "flag",
    "legacy_int",
    "lenient_double",
    "load_date",
    "amount",
    "money",
    "money_sum",
    "money_total",
    "pct",
    "pick",
    "safe_ratio",
    "surrogate_id",
    "typed_null",
]
