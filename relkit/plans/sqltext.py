"""Text fragments for the oracle SQL (DuckDB dialect).

They spell out, in SQL, the same exact-arithmetic conventions the Spark side
uses (decimal sums of two-decimal prices, rounding in decimal) so both engines produce identical doubles.
"""


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def sum_money(x: str) -> str:
    return f"CAST(sum({money(x)}) AS DOUBLE)"


def rhu(x: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST(({x}) AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def avg_money(x: str, digits: int = 2) -> str:
    return rhu(f"{sum_money(x)} / count({x})", digits)


def day(x: str) -> str:
    return f"CAST({x} AS DATE)"


def i32(x: str) -> str:
    return f"CAST({x} AS INTEGER)"


def i64(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def round_money(x: str, digits: int = 2) -> str:
    """ROUND on an exact decimal expression, returned as double."""
    return f"CAST(ROUND({x}, {digits}) AS DOUBLE)"
