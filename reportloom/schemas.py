"""Column lists of the report files and of the tables they fill."""

from __future__ import annotations

from dataclasses import dataclass

# The earnings columns, in file order.
EARNINGS_COLUMNS = (
    "description",
    "transaction_date",
    "transaction_time",
    "tax_type",
    "transaction_type",
    "refund_type",
    "product_title",
    "product_id",
    "product_type",
    "sku_id",
    "hardware",
    "buyer_country",
    "buyer_state",
    "buyer_postal_code",
    "buyer_currency",
    "amount_buyer_currency",
    "currency_conversion_rate",
    "merchant_currency",
    "amount_merchant_currency",
)
EARNINGS_AMOUNTS = (
    "amount_buyer_currency",
    "currency_conversion_rate",
    "amount_merchant_currency",
)
# The day that an earnings row's text date names.
EARNINGS_DAY = "transaction_day"
EARNINGS_AMOUNT_TYPE = "decimal(18,6)"

DEVICE_COLUMNS = ("retail_branding", "marketing_name", "device", "model")

# A sales row is cut to this many columns, and the columns at
# these positions are numbers.
SALES_WIDTH = 17
SALES_DATE = 1
# Fixed value: the header of the product id in sales reports.
PRODUCT_HEADER = "Product ID"
SALES_NUMBERS = {2: "bigint", 10: "decimal(18,2)", 11: "decimal(18,2)", 12: "decimal(18,2)"}
SALES_COLUMNS = (
    "order_number",
    "order_date",
    "order_timestamp",
    "financial_status",
    "device_model",
    "product_title",
    "product_id",
    "product_type",
    "sku_id",
    "currency",
    "item_price",
    "taxes",
    "charged_amount",
    "buyer_city",
    "buyer_state",
    "buyer_postal_code",
    "buyer_country",
)

MANIFEST_SCHEMA = "entries array<struct<url: string, mandatory: boolean>>"


def text_schema(names) -> str:
    """Read schema with every named column as text."""
    return ", ".join(f"`{n}` string" for n in names)


def positional(width: int) -> tuple[str, ...]:
    """``c0 … c<width-1>``: names for columns known only by position."""
    return tuple(f"c{i}" for i in range(width))


COLUMN_KINDS = ("date", "any_date", "time", "text", "metric")


@dataclass(frozen=True)
class FeedColumn:
    """One table column: its position in the report, what it holds, its type."""

    name: str
    source: int
    kind: str  # one of COLUMN_KINDS
    type: str = "string"

    def __post_init__(self) -> None:
        if self.kind not in COLUMN_KINDS:
            raise ValueError(f"unknown kind {self.kind!r} of {self.name!r}, expected one of {COLUMN_KINDS}")


@dataclass(frozen=True)
class FeedSpec:
    """A report feed: how its positions become table columns."""

    name: str
    date_column: str
    columns: tuple[FeedColumn, ...]

    @property
    def width(self) -> int:
        return max(c.source for c in self.columns) + 1


def _crash_feed(name: str, has_dimension: bool) -> FeedSpec:
    metrics_from = 3 if has_dimension else 2
    dimension = (FeedColumn("dimension", 2, "text"),) if has_dimension else ()
    return FeedSpec(
        name,
        "crash_date",
        (
            FeedColumn("crash_date", 0, "date"),
            FeedColumn("package_name", 1, "text"),
            *dimension,
            FeedColumn("daily_crashes", metrics_from, "metric", "bigint"),
            FeedColumn("daily_anrs", metrics_from + 1, "metric", "decimal(18,2)"),
        ),
    )


# The overview report has no dimension column, so its numbers start one earlier.
CRASH_FEEDS = (
    _crash_feed("app_version", True),
    _crash_feed("device", True),
    _crash_feed("os_version", True),
    _crash_feed("overview", False),
)
CRASH_FEED_NAMES = tuple(f.name for f in CRASH_FEEDS)

INSTALLS_FEED = FeedSpec(
    "installs_country",
    "install_date",
    (
        FeedColumn("install_date", 0, "date"),
        FeedColumn("package_name", 1, "text"),
        FeedColumn("country", 2, "text"),
        FeedColumn("daily_installs", 3, "metric", "bigint"),
        FeedColumn("daily_uninstalls", 4, "metric", "bigint"),
    ),
)
