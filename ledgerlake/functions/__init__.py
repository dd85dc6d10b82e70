from ledgerlake.functions.cleaning import (blank_to_default, cast_col, safe_decimal,
                                          to_date_col, to_timestamp_col, trim_columns)
from ledgerlake.functions.money import (discount_amount, gross_amount, net_amount,
                                        sql_net_amount_expr, unit_profit)

__all__ = [
    "blank_to_default", "cast_col", "safe_decimal", "to_date_col", "to_timestamp_col",
    "trim_columns", "discount_amount", "gross_amount", "net_amount",
    "sql_net_amount_expr", "unit_profit",
]
