"""Column expressions with PostgreSQL-observable semantics.

Everything here returns a ``Column`` built from built-in functions, so it
stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from decimal import Decimal
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- dates

def to_day(c: ColumnOrName) -> Column:
    """Timestamp (or string) to DATE."""
    return F.to_date(_c(c))


def us_date(text: str) -> Column:
    """A ``'MM/DD/YYYY'`` literal as DATE (Spark's cast only takes ISO)."""
    return F.to_date(F.lit(text), "MM/dd/yyyy")


def pg_dow(c: ColumnOrName) -> Column:
    """``EXTRACT(DOW ...)``: Sunday = 0 .. Saturday = 6."""
    return F.dayofweek(_c(c)) - F.lit(1)


def pg_day_name(c: ColumnOrName) -> Column:
    """``TO_CHAR(d, 'Day')``: English day name blank-padded to 9 characters."""
    return F.rpad(F.date_format(_c(c), "EEEE"), 9, " ")


def days_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """``date - date`` as an integer number of days."""
    return F.datediff(to_day(later), to_day(earlier))


def add_weeks(c: ColumnOrName, n: int) -> Column:
    return F.date_add(to_day(c), 7 * n)


def year_range(c: ColumnOrName, year: int) -> Column:
    """``EXTRACT(YEAR FROM c) = year`` written as a range the scan can use.

    ``year(c) = 1997`` is not pushed into Parquet; ``c >= a AND c < b`` is,
    and it is also usable for row-group statistics and partition pruning.
    """
    col = _c(c)
    lo = F.lit(f"{year}-01-01").cast("date")
    hi = F.lit(f"{year + 1}-01-01").cast("date")
    return (col >= lo) & (col < hi)


# ---------------------------------------------------------------- labels

def yes_no(c: ColumnOrName) -> Column:
    """1 -> 'Yes', 0 -> 'No', anything else (incl. NULL) -> 'Unknown'."""
    col = _c(c)
    return F.when(col == 1, "Yes").when(col == 0, "No").otherwise("Unknown")


def code_label(c: ColumnOrName, mapping: dict, default: str | None = None) -> Column:
    """Searched CASE mapping literal codes to labels; unmatched -> default."""
    col = _c(c)
    expr = None
    for code, label in mapping.items():
        expr = F.when(col == F.lit(code), label) if expr is None else expr.when(col == F.lit(code), label)
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def band(c: ColumnOrName, uppers: Sequence[tuple], top_label: str,
         null_label: str | None = None, inclusive: bool = False) -> Column:
    """Range banding: first ``(upper, label)`` with ``value < upper`` wins.

    ``inclusive=True`` uses ``<=``.  Values above every bound get
    ``top_label``; NULL gets ``null_label`` (NULL by default, i.e. kept).
    """
    col = _c(c)
    expr = F.when(col.isNull(), F.lit(null_label))
    for upper, label in uppers:
        cond = col <= F.lit(upper) if inclusive else col < F.lit(upper)
        expr = expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(top_label))


# ---------------------------------------------------------------- numbers

def money(c: ColumnOrName, precision: int = 18) -> Column:
    """Exact two-decimal value of a price stored as double."""
    return _c(c).cast(f"decimal({precision},2)")


def dec(value: str) -> Column:
    """An exact decimal literal, e.g. ``dec('1.10')``."""
    d = Decimal(value)
    scale = max(0, -d.as_tuple().exponent)
    return F.lit(d).cast(f"decimal({max(len(d.as_tuple().digits), scale + 1)},{scale})")


def round_money(c: ColumnOrName, digits: int = 2) -> Column:
    """ROUND on a decimal (half up, as PostgreSQL numeric), returned as double."""
    return F.round(_c(c), digits).cast("double")


def round_half_up(c: ColumnOrName, digits: int = 2) -> Column:
    """ROUND of a double as PostgreSQL rounds numeric: in decimal, halves away from zero."""
    return F.round(_c(c).cast("decimal(38,10)"), digits).cast("double")


def sum_money(c: ColumnOrName) -> Column:
    """Exact sum of two-decimal doubles (decimal accumulation), as double."""
    return F.sum(money(c)).cast("double")


def avg_money(c: ColumnOrName, digits: int = 2) -> Column:
    """``ROUND(AVG(x), 2)`` computed from an exact decimal sum."""
    return round_half_up(F.sum(money(c)).cast("double") / F.count(_c(c)), digits)


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Division that yields NULL instead of raising on a zero denominator."""
    return F.try_divide(_c(num), _c(den))


def pct_change(before: ColumnOrName, after: ColumnOrName) -> Column:
    """``(after - before) / before * 100``; NULL when ``before`` is 0 or NULL."""
    return safe_div(_c(after) - _c(before), _c(before)) * F.lit(100.0)


def mean_of_present(cols: Iterable[ColumnOrName]) -> Column:
    """Mean of the non-NULL values among several columns (NULL if none)."""
    cols = [_c(c) for c in cols]
    total = None
    present = None
    for col in cols:
        v = F.coalesce(col, F.lit(0.0))
        n = F.when(col.isNotNull(), F.lit(1)).otherwise(F.lit(0))
        total = v if total is None else total + v
        present = n if present is None else present + n
    return total / F.nullif(present, F.lit(0))


def mean_arterial_pressure(systolic: ColumnOrName, diastolic: ColumnOrName) -> Column:
    """MAP = (systolic + 2 * diastolic) / 3, in double arithmetic."""
    return (_c(systolic).cast("double") + F.lit(2.0) * _c(diastolic).cast("double")) / F.lit(3.0)


def bmi(weight_kg: ColumnOrName, height_m: ColumnOrName) -> Column:
    """Body-mass index w / h^2 (h*h, so every engine rounds identically)."""
    h = _c(height_m).cast("double")
    return _c(weight_kg).cast("double") / (h * h)


# ---------------------------------------------------------------- strings

def pg_concat(*cols: ColumnOrName) -> Column:
    """``a || b || c``: NULL if any operand is NULL (unlike concat_ws)."""
    return F.concat(*[_c(c) for c in cols])


def split_part(c: ColumnOrName, delimiter: str, n: int) -> Column:
    return F.split_part(_c(c), F.lit(delimiter), F.lit(n))


def char_positions(c: ColumnOrName, ch: str, ignore_case: bool = True) -> Column:
    """1-based positions of ``ch`` in a string, as ``array<int>``.

    Matches ``ARRAY(SELECT i FROM generate_series(1, char_length(s)) ...)``:
    an empty or NULL string gives an empty array (``sequence(1, 0)`` would
    otherwise produce ``[1, 0]``).
    """
    s = F.lower(_c(c)) if ignore_case else _c(c)
    target = ch.lower() if ignore_case else ch
    n = F.char_length(s)
    found = F.filter(F.sequence(F.lit(1), n), lambda i: F.substring(s, i, 1) == F.lit(target))
    return F.when(F.coalesce(n, F.lit(0)) > 0, found).otherwise(F.array().cast("array<int>"))


def ntz_micros(col: Column | str) -> Column:
    """Microseconds of a timestamp without time zone, in its own order whatever the session's zone is."""
    c = F.col(col) if isinstance(col, str) else col
    day = F.unix_date(F.to_date(c)).cast("long") * 86_400_000_000
    seconds = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return day + F.hour(c).cast("long") * 3_600_000_000 + F.minute(c).cast("long") * 60_000_000 + seconds
