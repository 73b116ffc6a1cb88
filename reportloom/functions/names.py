"""What object and file names say: report, feed, account, month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportloom.schemas import CRASH_FEED_NAMES


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(name: Column) -> Column:
    """Text after the last dot; the whole name when there is no dot."""
    return F.element_at(F.split(name, r"\."), -1)


def stem(name: Column) -> Column:
    """The name with its extension taken out."""
    return F.replace(name, F.concat(F.lit("."), extension(name)), F.lit(""))


def archive_number(path: Column) -> Column:
    """Text after the last dash of the archive name, ``.zip`` left out."""
    name = F.replace(base_name(path), F.lit(".zip"), F.lit(""))
    return F.element_at(F.split(name, "-"), -1)


def numbered_member(member: Column, path: Column) -> Column:
    """Member name with the archive number, so that archives of a month do not clash."""
    return F.concat(
        stem(member), F.lit("_"), archive_number(path), F.lit("."), extension(member)
    )


def classify_feed(name: Column, feeds: Sequence[str] = CRASH_FEED_NAMES) -> Column:
    """First feed, in the given order, whose name occurs in the base name."""
    base = base_name(name)
    return F.coalesce(*(F.when(F.contains(base, F.lit(f)), F.lit(f)) for f in feeds))


def classify_tenant(name: Column, labels: Sequence[str]) -> Column:
    """Last label, in the given order, that occurs in the base name."""
    base = base_name(name)
    return F.coalesce(
        *(F.when(F.contains(base, F.lit(t)), F.lit(t)) for t in reversed(labels))
    )


def required(label: Column, name: Column) -> Column:
    """A class that was found in ``name``; a name of no class fails the job."""
    told = F.concat(F.lit("no class in the name: "), F.coalesce(name, F.lit("NULL")))
    return F.coalesce(label, F.raise_error(told).cast("string"))


def match_report(name: Column, months: Sequence[str]) -> Column:
    """Report kind of an object of one of ``months``, NULL when it is none.

    Patterns hold from the start of the name; what follows them is free.
    """
    month = "(?:" + "|".join(months) + ")"
    # Object name patterns of the reports.
    patterns = {
        "earnings": rf"^earnings/earnings_{month}_.*\.zip",
        "sales": rf"^sales/salesreport_{month}\.zip",
        "stats_installs_country": rf"^stats/installs/installs_.*_{month}_country.csv",
        "stats_installs_device": rf"^stats/installs/installs_.*_{month}_device.csv",
    }
    return F.coalesce(
        *(F.when(name.rlike(p), F.lit(report)) for report, p in patterns.items())
    )


def sub_folder(report: Column) -> Column:
    """Folder in which a report kind is kept."""
    return F.when(report.isin("earnings", "sales"), report).when(
        report.isNotNull(), F.lit("stats/installs")
    )
