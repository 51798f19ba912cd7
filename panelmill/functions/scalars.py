"""Scalar rules shared by plans."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_double(text: Column) -> Column:
    """A double from text; NULL for anything that is no number, not finite, or a word for nothing."""
    return finite(text.try_cast("double"))


def finite(x: Column) -> Column:
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def div(a: Column, b: Column) -> Column:
    """a / b, NULL where b is 0."""
    return F.try_divide(a, b)


def correlation(a: str, b: str) -> Column:
    """Pearson correlation as an aggregate; NULL where one side doesn't vary, which ``corr`` in ANSI mode fails on."""
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def net_return(x: Column, bps: float) -> Column:
    """A return less the cost of a round trip of ``bps`` a side."""
    return x - 2 * bps / 10_000


def mid_amount(amount: Column, edges: tuple[float, ...] = (1_000, 15_000, 50_000, 100_000, 250_000, 500_000, 1_000_000)) -> Column:
    """The midpoint of the disclosure range that an amount falls into."""
    out = F.lit(float(edges[-1]))
    for low, high in reversed(list(zip((0.0, *edges[:-1]), edges, strict=True))):
        out = F.when(amount < high, (low + high) / 2).otherwise(out)
    return out


_NAME = re.compile(r"^[a-z][a-z0-9_]*$")


def checked_expression(name: str, expression: str) -> Column:
    """A column from a configured expression; names are plain identifiers and statements can't be smuggled in."""
    if not _NAME.match(name):
        raise ValueError(f"bad signal name {name!r}")
    if any(x in expression for x in (";", "--", "/*")):
        raise ValueError(f"bad expression for {name}")
    return F.expr(expression).alias(name)


# A quote service's fields that the serving table carries.
QUOTE_TEXTS = ("shortName", "longName", "sector", "industry", "country", "currency", "exchange")
QUOTE_NUMBERS = (
    "marketCap", "trailingPE", "forwardPE", "priceToBook", "trailingEps", "forwardEps", "dividendRate", "dividendYield", "payoutRatio", "beta", "profitMargins",
    "operatingMargins", "grossMargins", "revenueGrowth", "earningsGrowth", "returnOnEquity", "returnOnAssets", "debtToEquity", "currentRatio", "freeCashflow",
)


def snake_case(name: str) -> str:
    """``trailingPE`` as ``trailing_pe``; the raw dividend yield is marked, as a cleaned one goes by its name."""
    out = re.sub(r"(?<=[a-z])(?=[A-Z])", "_", name).lower()
    return "dividend_yield_raw" if out == "dividend_yield" else out


def quoted_fields() -> list[Column]:
    return [F.col(c).alias(snake_case(c)) for c in (*QUOTE_TEXTS, *QUOTE_NUMBERS)]
