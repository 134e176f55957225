"""Column expressions shared by every job (all JVM-side, codegen-friendly)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(19,4)"
MONEY_SUM = "decimal(38,4)"
RATE = "decimal(19,8)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """NUMERIC(19,4) money value."""
    return col(c).cast(MONEY)


def money_sum(c: Column | str) -> Column:
    """SUM of money, widened to DECIMAL(38,4) so both engines agree on the type."""
    return F.sum(col(c)).cast(MONEY_SUM)


def signed_amount(type_col: str = "type", amount_col: str = "amount") -> Column:
    """CREDIT = money into the wallet (+), DEBIT = out (-)."""
    return (F.when(F.col(type_col) == "CREDIT", F.col(amount_col))
            .when(F.col(type_col) == "DEBIT", -F.col(amount_col)))


def sum_where(cond: Column, amount_col: str = "amount") -> Column:
    """COALESCE(SUM(amount) FILTER (WHERE cond), 0) as DECIMAL(38,4)."""
    return F.coalesce(F.sum(F.when(cond, F.col(amount_col))), F.lit(0)).cast(MONEY_SUM)


def posting_month(ts: Column | str) -> Column:
    """yyyy-MM of a posting time; the partition column of the entries fact."""
    return F.date_format(col(ts), "yyyy-MM")


def month_start(month: str) -> dt.datetime:
    y, m = (int(x) for x in month.split("-"))
    return dt.datetime(y, m, 1)


def month_end(month: str) -> dt.datetime:
    y, m = (int(x) for x in month.split("-"))
    return dt.datetime(y + (m == 12), m % 12 + 1, 1)


def half_open(c: Column | str, start, end) -> Column:
    """[start, end) -- never BETWEEN, which would include the upper bound."""
    return (col(c) >= F.lit(start)) & (col(c) < F.lit(end))


def month_predicate(month: str, ts_col: str = "created_at", month_col: str = "posting_month") -> Column:
    """Range on the timestamp plus equality on the partition column.

    The range alone leaves ``PartitionFilters: []``; the extra equality on the
    directory column lets the scan open one month only.
    """
    return (F.col(month_col) == F.lit(month)) & half_open(ts_col, month_start(month), month_end(month))


def hash32(c: Column) -> Column:
    """Deterministic 32-bit hash reproducible in DuckDB: first 8 hex digits of md5."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint")


def ms_interval(ms: Column) -> Column:
    """Milliseconds as a day-time interval."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), ms.cast("decimal(18,6)") / F.lit(1000))


def domain_ok(c: str, allowed) -> Column:
    """CHECK semantics: NULL passes, otherwise the value must be in the set."""
    return F.col(c).isNull() | F.col(c).isin(list(allowed))
