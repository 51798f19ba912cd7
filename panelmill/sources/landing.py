"""Landing raw files as typed, provenance-stamped tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clean_double, mid_amount
from ..operators.windows import latest_per_key


def with_provenance(df: DataFrame, run_id: str, source: str, event: Column, ingest: Column | None = None, load_type: str = "full") -> DataFrame:
    return df.withColumns(
        {
            "_run_id": F.lit(run_id), "_ingest_ts": F.current_timestamp() if ingest is None else ingest, "_source_system": F.lit(source),
            "_source_event_ts": event.cast("timestamp"), "_load_type": F.lit(load_type),
        }
    )


def land_prices(raw: DataFrame, since: str) -> DataFrame:
    """Lower-case columns, rows with a close from ``since`` on; a missing volume stays NULL."""
    df = raw.toDF(*(c.lower() for c in raw.columns))
    return df.filter(F.col("close").isNotNull() & (F.col("date") >= F.lit(since).cast("date"))).withColumn("volume", F.col("volume").cast("long"))


def land_numbers(raw: DataFrame, columns: list[str]) -> DataFrame:
    """Typed fields from text; words for nothing, garbage and infinities are NULL."""
    return raw.withColumns({c: clean_double(F.col(c)) for c in columns})


def land_series(raw: DataFrame, names: dict[str, str], series: str = "series", value: str = "value") -> DataFrame:
    """Long series with their configured names; unknown series go."""
    named = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return raw.withColumn("name", named[F.col(series)]).filter("name is not null").withColumn(value, clean_double(F.col(value).cast("string")))


def land_factors(first: DataFrame, second: DataFrame, columns: list[str]) -> DataFrame:
    """Two wide factor files (``date`` as yyyyMMdd, percent) as one long table of fractions; footers don't parse and go."""
    typed = lambda df: df.withColumn("date", F.to_date(F.try_to_timestamp(F.trim("date"), F.lit("yyyyMMdd")))).filter("date is not null")
    wide = typed(first).join(typed(second), "date", "full_outer")
    long = wide.unpivot(["date"], columns, "factor", "value").withColumn("value", clean_double(F.col("value").cast("string")) / 100)
    return long.filter("value is not null")


def land_disclosures(raw: DataFrame, types: dict[str, str]) -> DataFrame:
    """Disclosures with mapped types, mixed date formats, ``--`` as NULL, amounts as midpoints of their ranges."""
    kinds = F.create_map(*[F.lit(x) for kv in types.items() for x in kv])
    dated = F.coalesce(F.to_date(F.try_to_timestamp("transaction_date", F.lit("yyyy-MM-dd"))), F.to_date(F.try_to_timestamp("transaction_date", F.lit("MM/dd/yyyy"))))
    return raw.withColumns(
        {"symbol": F.nullif(F.col("symbol"), F.lit("--")), "transaction_date": dated, "type": kinds[F.col("raw_type")], "amount_mid": mid_amount(F.col("amount"))}
    )


def flatten_facts(companies: DataFrame, wanted: DataFrame) -> DataFrame:
    """``symbol, taxonomy, tag, unit, ...`` from nested maps of facts (taxonomy, tag, units, entries).

    ``wanted(taxonomy, tag, unit)`` is a short configured list. Entries without a value or filing date go.
    """
    a = companies.select("symbol", F.explode("facts").alias("taxonomy", "tags"))
    b = a.select("symbol", "taxonomy", F.explode("tags").alias("tag", "fact"))
    c = b.select("symbol", "taxonomy", "tag", F.explode("fact.units").alias("unit", "entries")).join(F.broadcast(wanted), ["taxonomy", "tag", "unit"])
    d = c.select("symbol", "taxonomy", "tag", "unit", F.explode("entries").alias("e")).filter("e.val is not null and e.filed is not null")
    return d.select(
        "symbol", "taxonomy", "tag", "unit", F.to_date("e.start").alias("start_date"), F.to_date("e.end").alias("end_date"), F.col("e.val").alias("value"),
        F.col("e.fy").alias("fiscal_year"), F.col("e.fp").alias("fiscal_period"), F.col("e.form").alias("form"), F.to_date("e.filed").alias("filed"),
    )


def clean_listings(files: list[DataFrame]) -> DataFrame:
    """Exchange listings in order of precedence: no test issues, funds, odd symbols, junk names, footers; first file wins."""
    rows = None
    for k, f in enumerate(files):
        f = f.withColumn("_file", F.lit(k))
        rows = f if rows is None else rows.unionByName(f)
    junk = r"(?i)\b(warrant|right|unit|preferred|notes?)s?\b"
    rows = rows.filter("test_issue = 'N' and etf = 'N'").filter(F.col("symbol").rlike("^[A-Z]{1,5}$") & ~F.col("name").rlike(junk))
    return latest_per_key(rows, ["symbol"], F.col("_file")).drop("_file")


def journal_defects(trades: DataFrame) -> DataFrame:
    """Trades with the list of rules they break."""
    rules = {
        "no date": F.col("date").isNull(), "no symbol": F.coalesce(F.trim("symbol"), F.lit("")) == "", "no account": F.coalesce(F.trim("account"), F.lit("")) == "",
        "bad side": ~F.coalesce(F.col("side").isin("buy", "sell"), F.lit(False)), "bad quantity": ~F.coalesce(F.col("qty") > 0, F.lit(False)),
        "bad price": F.col("price") <= 0, "seed is a sale": F.col("seed") & (F.col("side") == "sell"), "seed without price": F.col("seed") & F.col("price").isNull(),
    }
    found = F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in rules.items())))
    return trades.withColumn("defects", found)


def checked_journal(trades: DataFrame) -> DataFrame:
    """The trades; reading a row with a defect raises."""
    bad = F.size("defects") > 0
    error = F.raise_error(F.concat(F.lit("journal: "), F.array_join("defects", ", "))).cast("boolean")
    return journal_defects(trades).filter(F.when(bad, error).otherwise(True)).drop("defects")


def migrated(symbols: DataFrame, successors: DataFrame) -> DataFrame:
    """Each symbol with its successor, or itself."""
    return symbols.join(successors, "symbol", "left").withColumn("current", F.coalesce("successor", "symbol"))
