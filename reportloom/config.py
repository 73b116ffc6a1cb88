"""What a load is told: accounts, months, feeds and the tables to fill."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from reportloom.schemas import (
    CRASH_FEEDS,
    DEVICE_COLUMNS,
    INSTALLS_FEED,
    SALES_COLUMNS,
    FeedColumn,
    FeedSpec,
)

LOADS = ("crashes", "both", "sales", "installs")
DATE_FORMATS = ("Past", "Range")


def month_span(first: date, last: date) -> list[str]:
    """``YYYYMM`` labels from the month of ``first`` to the month of ``last``, inclusive."""
    start = first.year * 12 + first.month - 1
    stop = last.year * 12 + last.month - 1
    return [f"{i // 12:04d}{i % 12 + 1:02d}" for i in range(start, stop + 1)]


def shift_month(day: date, months: int) -> date:
    """First day of the month ``months`` after (or before) the month of ``day``."""
    i = day.year * 12 + day.month - 1 + months
    return date(i // 12, i % 12 + 1, 1)


def _month_start(text: str) -> date:
    year, month = text.split("-")
    return date(int(year), int(month), 1)


def _feed(values: FeedSpec | Mapping) -> FeedSpec:
    if isinstance(values, FeedSpec):
        return values
    columns = tuple(FeedColumn(**c) for c in values["columns"])
    return FeedSpec(values["name"], values["date_column"], columns)


@dataclass(frozen=True)
class Target:
    """One warehouse endpoint: which feeds it skips and where its tables differ."""

    endpoint: str
    skip: frozenset[str] = frozenset()
    tables: Mapping[str, str] = field(default_factory=dict)

    def table_for(self, feed: str) -> str | None:
        return None if feed in self.skip else self.tables.get(feed, feed)


@dataclass(frozen=True)
class LoadConfig:
    """Settings of one run. ``run_date`` is a parameter so that retries agree.

    The column lists name the columns of the tables, in the order of the reports.
    """

    tenants: Mapping[str, str]
    run_date: date
    output_root: str
    load: str = "crashes"
    date_format: str = "Past"
    backfill: int = 1
    start_date: str | None = None
    end_date: str | None = None
    month_back: int = 1
    gate_days: tuple[int, int] = (1, 20)
    restricted: Mapping[str, str] = field(default_factory=dict)
    optional_tenants: frozenset[str] = frozenset()
    targets: tuple[Target, ...] = ()
    table_grain: str = "month"
    keep_raw: bool = False
    # Whether the objects are kept as delivered, byte by byte, each content once.
    keep_objects: bool = False
    # Whether reports all of whose lines are records are split among tasks.
    split_reports: bool = False
    # Whether feeds none of whose objects changed since they were loaded are left unread.
    changed_only: bool = False
    # Whether processed files and the manifests that list them are written.
    processed: bool = True
    crash_feeds: tuple[FeedSpec, ...] = CRASH_FEEDS
    installs_feed: FeedSpec = INSTALLS_FEED
    sales_columns: tuple[str, ...] = SALES_COLUMNS
    device_columns: tuple[str, ...] = DEVICE_COLUMNS

    def __post_init__(self) -> None:
        if self.load not in LOADS:
            raise ValueError(f"unknown load {self.load!r}, expected one of {LOADS}")
        if self.date_format not in DATE_FORMATS:
            raise ValueError(
                f"unknown date_format {self.date_format!r}, expected one of {DATE_FORMATS}"
            )
        if self.date_format == "Range" and not (self.start_date and self.end_date):
            raise ValueError("date_format 'Range' needs start_date and end_date (YYYY-MM)")

    @classmethod
    def from_dict(cls, values: Mapping, run_date: date) -> LoadConfig:
        """A run from plain settings; a name that is no setting is an error.

        A feed is given as ``name``, ``date_column`` and ``columns``, each of these
        with ``name``, ``source``, ``kind`` and, unless it is text, ``type``.
        """
        if unknown := sorted(set(values) - set(cls.__dataclass_fields__)):
            raise ValueError(f"unknown settings {unknown}")
        known = dict(values)
        if "crash_feeds" in known:
            known["crash_feeds"] = tuple(_feed(f) for f in known["crash_feeds"])
        if "installs_feed" in known:
            known["installs_feed"] = _feed(known["installs_feed"])
        for names in ("sales_columns", "device_columns"):
            if names in known:
                known[names] = tuple(known[names])
        known["targets"] = tuple(
            t if isinstance(t, Target) else Target(
                t["endpoint"], frozenset(t.get("skip", ())), dict(t.get("tables", {}))
            )
            for t in values.get("targets", ())
        )
        known["optional_tenants"] = frozenset(values.get("optional_tenants", ()))
        known["gate_days"] = tuple(values.get("gate_days", (1, 20)))
        return cls(**{**known, "run_date": run_date})

    def months(self) -> list[str]:
        """Months to request: the last ``backfill`` ones, or the given range."""
        if self.date_format == "Range":
            return month_span(_month_start(self.start_date), _month_start(self.end_date))
        return month_span(shift_month(self.run_date, 1 - int(self.backfill)), self.run_date)

    def label(self) -> str:
        """What tells this load from others of the same date: the months it asks for."""
        months = self.months()
        return f"{self.date_format}-{months[0]}-{months[-1]}" if months else self.date_format

    def earnings_month(self) -> date:
        """The month that an earnings run both deletes and loads."""
        return shift_month(self.run_date, -self.month_back)

    def feeds(self) -> list[str]:
        """Feeds that this load asks for."""
        if self.load == "crashes":
            return [feed.name for feed in self.crash_feeds]
        store = {"sales": "sales", "installs": self.installs_feed.name}
        return [name for load, name in store.items() if self.load in ("both", load)]
