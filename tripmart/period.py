"""The load period: a (year, month) pair rendered ``yyyy`` / ``MM``."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# English month names, January first.
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December"]


@dataclass(frozen=True)
class Period:
    year: str
    month: str

    def __post_init__(self):
        y, m = int(self.year), int(self.month)
        if not (1 <= m <= 12) or not (0 < y < 10000):
            raise ValueError(f"bad period {self.year}-{self.month}")
        object.__setattr__(self, "year", f"{y:04d}")
        object.__setattr__(self, "month", f"{m:02d}")

    @property
    def y(self) -> int:
        return int(self.year)

    @property
    def m(self) -> int:
        return int(self.month)

    def first_day(self) -> dt.date:
        return dt.date(self.y, self.m, 1)

    def last_day(self) -> dt.date:
        return dt.date(self.y + self.m // 12, self.m % 12 + 1, 1) - dt.timedelta(days=1)

    def __str__(self) -> str:
        return f"{self.year}-{self.month}"


def month_number(month) -> int:
    """Month argument as a number: accepts 11, '11', 'November' or 'Nov'
    (case-insensitive); anything else is an error."""
    if isinstance(month, int):
        m = month
    else:
        s = str(month).strip()
        if s.isdigit():
            m = int(s)
        else:
            low = s.lower()
            hits = [i + 1 for i, n in enumerate(MONTH_NAMES) if low in (n.lower(), n.lower()[:3])]
            if len(hits) != 1:
                raise ValueError(f"unknown month {month!r}")
            m = hits[0]
    if not 1 <= m <= 12:
        raise ValueError(f"month out of range: {month!r}")
    return m


def default_period(year: str | None = None, month: str | None = None,
                   today: dt.date | None = None, lag_months: int = 3) -> Period:
    """Explicit year and month when both are given, else ``today`` minus
    ``lag_months`` (the latest month the public feeds have published)."""
    if year and month:
        return Period(str(year), str(month))
    today = today or dt.date.today()
    idx = today.year * 12 + (today.month - 1) - lag_months
    return Period(str(idx // 12), str(idx % 12 + 1))


def recent_periods(n: int, lag_months: int = 0, today: dt.date | None = None) -> list[Period]:
    """The ``n`` months up to ``today`` minus ``lag_months``, oldest first."""
    return [default_period(today=today, lag_months=lag_months + i) for i in reversed(range(n))]
