"""Paged analytics reports: nested pages to one row per record."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The parts of a report page that are read.
PAGE_SCHEMA = """
reports array<struct<
  columnHeader: struct<
    dimensions: array<string>,
    metricHeader: struct<metricHeaderEntries: array<struct<name: string>>>>,
  data: struct<rows: array<struct<
    dimensions: array<string>,
    metrics: array<struct<values: array<string>>>>>>,
  nextPageToken: string>>
"""
NAME_PREFIX = "ga:"


@dataclass(frozen=True)
class Report:
    """Dimensions and metrics of a report, and the columns that identify a record."""

    dimensions: tuple[str, ...]
    metrics: tuple[str, ...]
    keys: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [*self.dimensions, *self.metrics]


# The known reports.
REPORTS = {
    "usr": Report(
        ("dimension6", "dimension5"),
        ("sessions",),
        ("dimension6", "dimension5", "sessions", "date"),
    ),
    "ad_cost": Report(
        ("date", "adwordsCampaignID", "campaign", "keyword"),
        ("adClicks", "adCost"),
        ("adClicks", "adCost", "adwordsCampaignID", "campaign", "keyword", "date"),
    ),
    "cx": Report(
        ("dimension6", "hostname", "pagePath", "eventAction", "eventCategory", "dimension1"),
        ("users",),
        ("dimension6", "eventAction", "dimension1"),
    ),
    "server_cx": Report(
        (
            "dimension5", "hostname", "pagePath", "eventAction", "eventCategory", "dimension1",
            "dateHourMinute", "date",
        ),
        ("users",),
        ("dimension5", "eventAction", "dimension1"),
    ),
    "acquisition": Report(
        (
            "dimension6", "sourceMedium", "landingPagePath", "fullReferrer", "campaign",
            "adwordsCampaignID", "dimension1", "keyword",
        ),
        ("newUsers",),
        ("dimension6", "dimension1"),
    ),
    "acquisition_funnel": Report(
        (
            "dimension6", "sourceMedium", "pagePath", "campaign", "adwordsCampaignID", "keyword",
            "dimension1",
        ),
        ("uniquePageViews",),
        ("dimension6", "dimension1"),
    ),
}


def _value_of(name: str, headers: Column, values: Column) -> Column:
    """The value under header `name`; null when either list is too short."""
    return F.get(values, F.array_position(headers, name).cast("int") - 1)


def flatten_report(
    pages: DataFrame, columns: Sequence[str], run_date: Column | str, import_ts: Column | str
) -> DataFrame:
    """One row per report row, every value as text.

    Only the first report of a page counts. A metric wins over a dimension of
    the same name and either wins over the run date; of several date ranges the
    last one stays. A row without any date range has no values at all.
    """
    report = F.get("reports", F.lit(0))
    clean = lambda h: F.replace(h, F.lit(NAME_PREFIX), F.lit(""))
    metric_entries = report["columnHeader"]["metricHeader"]["metricHeaderEntries"]
    rows = pages.select(
        F.transform(report["columnHeader"]["dimensions"], clean).alias("dims"),
        F.transform(metric_entries, lambda e: clean(e["name"])).alias("mets"),
        F.explode(report["data"]["rows"]).alias("row"),
    )
    has_range = F.size(F.col("row.metrics")) > 0
    last_range = F.get("row.metrics", F.size("row.metrics") - 1)["values"]
    constants = {"date": run_date, "import_ts": import_ts}
    out = []
    for name in dict.fromkeys(["date", "import_ts", *columns]):
        options = [
            _value_of(name, F.col("mets"), last_range),
            _value_of(name, F.col("dims"), F.col("row.dimensions")),
        ]
        if name in constants:
            value = constants[name]
            options.append(value if isinstance(value, Column) else F.lit(value))
        out.append(F.when(has_range, F.coalesce(*options)).alias(name))
    return rows.select(*out)


def next_page_token(pages: DataFrame) -> DataFrame:
    """The pages that name a further page."""
    token = F.get("reports", F.lit(0))["nextPageToken"]
    return pages.select(token.alias("next_page_token")).where(token.isNotNull())
