"""The given star-schema tables as market data: every frame is derived by deterministic rules."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sinks import clustered

#: Exchange rate from the order lines' currency to that of the prices.
RATE = 0.91371693
#: Brands that play the two benchmark funds.
SPY, QQQ = "Brand#1", "Brand#10"


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    sf_dir: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def lines(self) -> DataFrame:
        """Order lines with their brand and price of a unit; parts are joined by Spark's own size check."""
        return (
            self.read("lineitem").join(self.read("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
            .withColumn("px", F.col("l_extendedprice") / F.col("l_quantity") * RATE)
        )

    def bars(self) -> DataFrame:
        """``symbol, date, open, high, low, close, volume``: a brand's day of order lines, first to last by order and line."""
        place = F.struct("l_orderkey", "l_linenumber", "px")
        return (
            self.lines().groupBy(F.col("p_brand").alias("symbol"), F.to_date("l_shipdate").alias("date"))
            .agg(F.min_by("px", place).alias("open"), F.max("px").alias("high"), F.min("px").alias("low"),
                 F.max_by("px", place).alias("close"), F.sum("l_quantity").cast("long").alias("volume"))
        )

    @cached_property
    def prices(self) -> DataFrame:
        """The bars as a stored table in buckets of the symbol, which plans read without a shuffle: asking for it runs the job that writes it."""
        return clustered(self.bars(), "bars", "symbol", "date")

    def raw_prices(self) -> DataFrame:
        """Bars with dividends (1% of the close, every 180th day number) and 2:1 splits (every 700th)."""
        day = F.datediff("date", F.lit("1970-01-01"))
        return self.prices.withColumn("dividend", F.when(day % 180 == 0, F.col("close") * 0.01).otherwise(0.0)).withColumn(
            "split_ratio", F.when(day % 700 == 0, 2.0).otherwise(0.0)
        )

    def landed_prices(self) -> DataFrame:
        """Bars as two runs landed them: the second run corrects every seventh day's close and came later."""
        bars = self.bars()
        first = bars.select("*", F.lit("run-1").alias("_run_id"), F.lit("2024-01-01").cast("timestamp").alias("_ingest_ts"))
        fixed = bars.filter(F.datediff("date", F.lit("1970-01-01")) % 7 == 0).withColumn("close", F.col("close") * 1.5)
        return first.unionByName(fixed.select("*", F.lit("run-2").alias("_run_id"), F.lit("2024-01-02").cast("timestamp").alias("_ingest_ts")))

    def facts(self) -> DataFrame:
        """As-filed yearly facts of each brand: filed 45 days after the year; a restatement 1% higher a year later.

        Filers differ as real ones do: in even years revenue has the newer tag too, 2% lower, beside older ones; a brand
        whose number divides by 3 files its cost, by 4 its equity, under the least preferred tag. Facts of other
        taxonomies, a thousand times too large, are there to be left alone.
        """
        year, number = F.year("l_shipdate"), F.regexp_extract("symbol", r"(\d+)", 1).cast("int")
        price, disc = F.col("l_extendedprice"), F.col("l_discount")
        sums = self.lines().groupBy(F.col("p_brand").alias("symbol"), year.alias("fiscal_year")).agg(
            F.round(F.sum(price), 2).alias("Revenues"), F.round(F.sum(price * (1 - disc)), 4).alias("CostOfRevenue"),
            F.round(F.sum(price * disc), 4).alias("NetIncomeLoss"), F.round(F.sum("l_quantity"), 0).alias("EntityCommonStockSharesOutstanding"),
            F.round(F.sum(price) * 3, 2).alias("Assets"), F.round(F.sum(price) * 2, 2).alias("StockholdersEquity"),
        )
        value = lambda name: F.col(name).cast("double")
        revenue = value("Revenues")
        # (tag, value, whether it is a stock without a start)
        filed = [
            (F.lit("Revenues"), revenue, False), (F.lit("SalesRevenueNet"), F.round(revenue * 0.9, 4), False),
            (F.when(F.col("fiscal_year") % 2 == 0, "RevenueFromContractWithCustomerExcludingAssessedTax"), F.round(revenue * 0.98, 4), False),
            (F.when(number % 3 == 0, "CostOfGoodsSold").otherwise("CostOfRevenue"), value("CostOfRevenue"), False),
            (F.lit("NetIncomeLoss"), value("NetIncomeLoss"), False), (F.lit("Assets"), value("Assets"), True),
            (F.lit("EntityCommonStockSharesOutstanding"), value("EntityCommonStockSharesOutstanding"), True),
            (F.when(number % 4 == 0, "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest").otherwise("StockholdersEquity"), value("StockholdersEquity"), True),
        ]
        fact = lambda tag, taxonomy, x, stock, form, days: F.when(tag.isNotNull(), F.struct(
            tag.alias("tag"), F.lit(taxonomy).alias("taxonomy"), x.alias("value"), F.lit(stock).alias("stock"), F.lit(form).alias("form"), F.lit(days).alias("days")))
        all_ = []
        for i, (tag, x, stock) in enumerate(filed):
            shares = i == 6
            for taxonomy, y in ((("dei" if shares else "us-gaap"), x), (("us-gaap" if shares else "ifrs-full"), x * 1000)):
                all_.append(fact(tag, taxonomy, y, stock, "10-K", 45))
                if i == 0:
                    all_.append(fact(tag, taxonomy, F.round(y * 1.01, 4), stock, "10-K/A", 45 + 365))
        end = F.make_date("fiscal_year", F.lit(12), F.lit(31))
        return sums.select("symbol", "fiscal_year", F.explode(F.array_compact(F.array(*all_))).alias("f")).select(
            "symbol", "f.taxonomy", "f.tag", F.when(~F.col("f.stock"), F.make_date("fiscal_year", F.lit(1), F.lit(1))).alias("start_date"),
            end.alias("end_date"), "f.value", "fiscal_year", F.lit("FY").alias("fiscal_period"), "f.form", F.date_add(end, F.col("f.days")).alias("filed"),
        )

    def profiles(self) -> DataFrame:
        """Snapshots of users' attributes: one per event."""
        return self.read("events").select(F.col("user_id").cast("string").alias("symbol"), "ts", "event_id", F.col("event_type").alias("sector"))

    def securities(self) -> DataFrame:
        """``symbol, sector, industry, sic, quote_type``: a brand's most common part type and size."""
        p = self.read("part")
        return p.groupBy(F.col("p_brand").alias("symbol")).agg(
            F.min("p_type").alias("sector"), F.max("p_type").alias("industry"),
            F.when(F.sum("p_size") % 5 == 0, "6221").otherwise("3571").alias("sic"), F.when(F.count("*") % 7 == 0, "ETF").otherwise("EQUITY").alias("quote_type"),
        )

    def disclosures(self) -> DataFrame:
        """Orders as disclosed transactions: segment, customer, status, priority, amount, and when they were disclosed."""
        shipped = self.read("lineitem").groupBy("l_orderkey").agg(F.to_date(F.max("l_shipdate")).alias("disclosure_date"))
        return (
            self.read("orders").join(self.read("customer"), F.col("o_custkey") == F.col("c_custkey")).join(shipped, F.col("o_orderkey") == F.col("l_orderkey"))
            .select(F.col("c_mktsegment").alias("symbol"), F.col("c_nationkey").alias("office"), F.substring("o_orderpriority", 1, 1).alias("owner"),
                    F.col("o_orderstatus").alias("raw_type"), F.col("o_totalprice").alias("amount"), F.to_date("o_orderdate").alias("transaction_date"),
                    "disclosure_date", F.col("o_orderkey").alias("id"))
        )

    def trades(self) -> DataFrame:
        """Order lines as buys; each with an even line number is half sold 30 days later."""
        buys = self.lines().join(self.read("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.concat(F.when(F.col("o_custkey") % 3 == 0, "ira-").when(F.col("o_custkey") % 5 == 0, "My 401(k)-").otherwise("tax-"), F.col("o_custkey").cast("string")).alias("account"),
            F.col("p_brand").alias("symbol"), F.to_date("l_shipdate").alias("date"), F.lit("buy").alias("side"), F.col("l_quantity").alias("qty"),
            F.when(F.col("l_linenumber") != 3, F.col("px")).alias("price"), F.struct("l_orderkey", "l_linenumber", "px").alias("id"), (F.col("l_linenumber") == 7).alias("seed"),
        )
        sells = buys.filter(F.col("id.l_linenumber") % 2 == 0).withColumn("qty", F.floor(F.col("qty") / 2).cast("double")).filter("qty > 0")
        sells = sells.withColumn("date", F.date_add("date", 30)).withColumn("side", F.lit("sell")).withColumn("seed", F.lit(False))
        return buys.unionByName(sells)


FACTS_JSON = T.MapType(
    T.StringType(),
    T.MapType(
        T.StringType(),
        T.StructType(
            [
                T.StructField(
                    "units",
                    T.MapType(
                        T.StringType(),
                        T.ArrayType(
                            T.StructType(
                                [T.StructField(n, t) for n, t in (("start", T.StringType()), ("end", T.StringType()), ("val", T.DoubleType()), ("fy", T.IntegerType()), ("fp", T.StringType()), ("form", T.StringType()), ("filed", T.StringType()))]
                            )
                        ),
                    ),
                )
            ]
        ),
    ),
)
