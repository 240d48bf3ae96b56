"""Month arithmetic and run stamps."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP_FORMAT = "yyyyMMdd_HHmmss"


def as_date(value: Column | str, fmt: str | None = None) -> Column:
    """A date from a date, timestamp or (with ``fmt``) text column; bad text gives null."""
    column = F.col(value) if isinstance(value, str) else value
    if fmt is None:
        return column.try_cast("date")
    return F.try_to_timestamp(column, F.lit(fmt)).cast("date")


def month_start(day: Column | str, offset: int = 0) -> Column:
    """First day of the month ``offset`` months away."""
    return F.trunc(F.add_months(day, offset), "MM")


def month_end(day: Column | str, offset: int = 0) -> Column:
    """Last day of the month ``offset`` months away."""
    return F.last_day(F.add_months(day, offset))


def month_label(day: Column | str) -> Column:
    return F.date_format(day, "yyyyMM")


def period_text(day: Column | str) -> Column:
    """The ISO form under which a period enters hashes and file names."""
    return F.date_format(day, "yyyy-MM-dd")


def run_stamp(moment: Column | None = None) -> Column:
    return F.date_format(F.current_timestamp() if moment is None else moment, STAMP_FORMAT)


def stamp_text(moment: datetime | None = None) -> str:
    """The same stamp on the driver, for table names."""
    return (moment or datetime.now()).strftime("%Y%m%d_%H%M%S")


def month_window(reference: str, fmt: str, months: int = 0, first_offset: int | None = None) -> tuple[date, date]:
    """Literal bounds for a scan: from ``reference`` to the end of the month
    ``months`` ahead. ``first_offset`` first moves to the start of the month
    that many months away."""
    start = datetime.strptime(reference, fmt).date()
    if first_offset is not None:
        start = _shift(start, first_offset)
    after = _shift(start, months + 1)
    return start, date.fromordinal(after.toordinal() - 1)


def _shift(day: date, months: int) -> date:
    years, month = divmod(day.year * 12 + day.month - 1 + months, 12)
    return date(years, month + 1, 1)
