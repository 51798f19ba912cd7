"""Queries over sources, sinks, joins, dimensions, data quality and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import QUOTE_NUMBERS, QUOTE_TEXTS, mid_amount, quoted_fields, snake_case
from ..operators.joins import valid_at, with_optional
from ..operators.quantiles import approximate, exact_quantiles, global_ranks, merged, sketched
from ..operators.scd2 import current, scd2_apply, versions
from ..operators.windows import bucket, carried, latest_per_key
from ..plans import calendar as cal
from ..plans import quality as qa
from ..plans import star
from ..plans.fundamentals import CONCEPTS, concepts, fundamentals_fact
from ..sources import commits, landing, sinks
from ..sources.tables import FACTS_JSON, Tables
from ..streaming import streams
from .gold import FACTS, KNOWN, SEC, known
from .prices import r4
from .sqltext import BARS, LINES, RAW

_TYPES = {"F": "purchase", "O": "sale", "P": "exchange"}


def src_01_prices(spark, d):
    t = Tables(spark, d)
    raw = t.bars().withColumnRenamed("close", "Close").withColumn("Close", F.when(F.dayofmonth("date") != 13, F.col("Close")))
    landed = landing.land_prices(raw, "1996-01-01")
    landed = landing.with_provenance(landed, "run-1", "files", F.col("date"), F.lit("2024-01-01").cast("timestamp"))
    return landed


def src_03_numbers(spark, d):
    c = Tables(spark, d).read("customer")
    k = F.col("c_custkey")
    raw = c.select("c_custkey", F.when(k % 50 == 0, "inf").when(k % 51 == 0, "None").when(k % 52 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string")).alias("balance"))
    return landing.land_numbers(raw, ["balance"])


def src_04_series(spark, d):
    e = Tables(spark, d).read("events").groupBy(F.col("event_type").alias("series"), F.to_date("ts").alias("date")).agg(F.count("*").cast("double").alias("value"))
    return landing.land_series(e, {"click": "clicks", "view": "views", "purchase": "sales"})


def src_05_factors(spark, d):
    e = Tables(spark, d).read("events").groupBy(F.date_format("ts", "yyyyMMdd").alias("date")).agg(
        F.count_if(F.col("event_type") == "click").alias("mkt"), F.count_if(F.col("event_type") == "view").alias("smb"), F.count_if(F.col("event_type") == "purchase").alias("mom")
    )
    foot = spark.range(1).select(F.lit("Copyright").alias("date"))
    one = e.filter("date <= '20240120'").select("date", "mkt", "smb").unionByName(foot, allowMissingColumns=True)
    return landing.land_factors(one, e.filter("date >= '20240110'").select("date", "mom"), ["mkt", "smb", "mom"])


def src_06_disclosures(spark, d):
    raw = Tables(spark, d).disclosures()
    raw = raw.withColumn("symbol", F.when(F.col("id") % 11 == 0, "--").otherwise(F.col("symbol"))).withColumn(
        "transaction_date", F.when(F.col("id") % 2 == 0, F.date_format("transaction_date", "yyyy-MM-dd")).otherwise(F.date_format("transaction_date", "MM/dd/yyyy"))
    )
    return landing.land_disclosures(raw, _TYPES).select("id", "symbol", "type", "transaction_date", "amount_mid")


def src_08_facts_json(spark, d):
    """All facts nested as JSON per company, and those of the wanted taxonomies and tags flattened again."""
    f = Tables(spark, d).facts()
    entry = F.struct(F.col("start_date").cast("string").alias("start"), F.col("end_date").cast("string").alias("end"), F.col("value").alias("val"), F.col("fiscal_year").alias("fy"), F.col("fiscal_period").alias("fp"), "form", F.col("filed").cast("string").alias("filed"))
    per_tag = f.groupBy("symbol", "taxonomy", "tag").agg(F.collect_list(entry).alias("entries"))
    unit = F.struct(F.create_map(F.when(F.col("tag").endswith("SharesOutstanding"), "shares").otherwise("USD"), F.col("entries")).alias("units"))
    tags = per_tag.groupBy("symbol", "taxonomy").agg(F.map_from_entries(F.collect_list(F.struct("tag", unit.alias("v")))).alias("tags"))
    text = tags.groupBy("symbol").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("taxonomy", "tags")))).alias("json"))
    wanted = [(taxonomy, tag, "shares" if taxonomy == "dei" else "USD") for taxonomy, *tags in CONCEPTS.values() for tag in tags]
    wanted = spark.createDataFrame(wanted, "taxonomy string, tag string, unit string")
    return landing.flatten_facts(text.select("symbol", F.from_json("json", FACTS_JSON).alias("facts")), wanted)


def src_09_listings(spark, d):
    """Suppliers as two pipe-delimited files of listings."""
    s = Tables(spark, d).read("supplier")
    k = F.col("s_suppkey")
    letters = F.translate(k.cast("string"), "0123456789", "ABCDEFGHIJ")
    line = F.concat_ws("|", F.when(k % 9 == 0, F.concat(letters, F.lit(".W"))).otherwise(letters), F.when(k % 8 == 0, F.concat("s_name", F.lit(" Warrant"))).otherwise(F.col("s_name")), F.when(k % 7 == 0, "Y").otherwise("N"), F.when(k % 6 == 0, "Y").otherwise("N"))
    schema = "symbol string, name string, test_issue string, etf string"
    parsed = s.select(F.from_csv(line, schema, {"sep": "|"}).alias("x"), "s_suppkey").select("x.*", "s_suppkey")
    first, second = parsed.filter(k % 2 == 0).drop("s_suppkey"), parsed.filter(k % 3 == 0).withColumn("name", F.lit("other")).drop("s_suppkey")
    return landing.clean_listings([first, second])


def src_12_without_facts(spark, d):
    t = Tables(spark, d)
    has = concepts(t.facts()).filter("year(end_date) >= 1996 and value > 5e7").select("symbol")
    return t.bars().select("symbol").distinct().join(has, "symbol", "left_anti")


def src_14_journal_defects(spark, d):
    t = Tables(spark, d).trades()
    t = t.withColumn("qty", F.when(F.col("id.l_orderkey") % 13 == 0, -F.col("qty")).otherwise(F.col("qty"))).withColumn("side", F.when(F.col("id.l_orderkey") % 17 == 0, "gift").otherwise(F.col("side")))
    bad = landing.journal_defects(t).withColumn("defect", F.explode("defects"))
    return bad.groupBy("defect").agg(F.count("*").alias("n"))


def src_16_migrated(spark, d):
    t = Tables(spark, d)
    s = t.securities().select("symbol")
    n = F.regexp_extract("symbol", r"(\d+)", 1).cast("int")
    successors = s.filter(n % 5 == 0).select("symbol", F.concat(F.lit("New#"), n.cast("string")).alias("successor"))
    return landing.migrated(s, successors).select("symbol", "current")


def snk_01_append(spark, d):
    """Two appends, the second with one more column, read as one table."""
    n = Tables(spark, d).read("nation")
    path = sinks.scratch(spark, "append")
    sinks.write_append(n.filter("n_nationkey < 10").select("n_nationkey", "n_name"), path)
    sinks.write_append(n.filter("n_nationkey >= 10"), path)
    return sinks.read_merged(spark, path).select("n_nationkey", "n_name", "n_regionkey")


def snk_03_upsert(spark, d):
    """The second run's rows merged by symbol and date into a table of years: only the years it touches are written."""
    landed = Tables(spark, d).landed_prices().drop("_ingest_ts")
    path, year = sinks.scratch(spark, "prices"), F.year("date")
    commits.rebuild(landed.filter("_run_id = 'run-1'"), path, year, ["symbol", "date"])
    commits.merge(landed.filter("_run_id = 'run-2'"), path, ["symbol", "date"], year, sort=["symbol", "date"])
    return commits.read(spark, path)


def snk_04_replace(spark, d):
    """All rows of the updates' symbols go, whichever year they are in; the updates are of late years alone."""
    b = Tables(spark, d).bars()
    n = F.regexp_extract("symbol", r"(\d+)", 1).cast("int")
    path, year = sinks.scratch(spark, "bars"), F.year("date")
    commits.rebuild(b, path, year)
    fresh = b.filter((n % 2 == 0) & (F.col("date") >= "2000-01-01")).withColumn("close", F.col("close") + 1)
    commits.merge(fresh, path, ["symbol"], year, keys_say_part=False)
    return commits.read(spark, path)


def snk_04_windows(spark, d):
    """Months that are fetched again, with fewer symbols, replace the months that were there."""
    b = Tables(spark, d).bars()
    path, month = sinks.scratch(spark, "bars"), F.date_format("date", "yyyy-MM")
    commits.rebuild(b, path, month)
    n = F.regexp_extract("symbol", r"(\d+)", 1).cast("int")
    commits.replace_windows(b.filter((n % 3 != 0) & F.col("date").between("1997-03-01", "1997-08-31")).withColumn("close", F.col("close") + 1), path, month)
    return commits.read(spark, path)


def snk_05_first_write(spark, d):
    """A round that is written twice keeps its first rows."""
    b = Tables(spark, d).bars().select("symbol", F.col("date").alias("as_of_date"), "close").withColumn("methodology_version", F.lit("v1"))
    path = sinks.scratch(spark, "rounds")
    commits.first_write(b.filter("as_of_date < '1997-01-01'"), path)
    commits.first_write(b.filter("as_of_date >= '1996-06-01'").withColumn("close", F.col("close") * 2), path)
    return commits.read(spark, path)


def snk_07_trials(spark, d):
    log = Tables(spark, d).read("region").select((F.col("r_regionkey") + 1).cast("int").alias("trial"), F.col("r_name").alias("variant"))
    new = Tables(spark, d).read("nation").filter("n_nationkey < 3").select(F.col("n_name").alias("variant"))
    path = sinks.scratch(spark, "trials")
    commits.rebuild(log, path, F.lit("log"))
    commits.log_trials(new, path, "variant")
    return commits.read(spark, path)


def events(t: Tables) -> DataFrame:
    return t.profiles().select(F.col("symbol"), "ts", "event_id", "sector")


def dim_03_versions(spark, d):
    v = versions(events(Tables(spark, d)), "symbol", ["sector"], "ts", ["event_id"])
    return v.drop("attr_hash")


def dim_04_scd2_apply(spark, d):
    """History up to a day as the current table, the newest later profiles as one batch of updates."""
    e = events(Tables(spark, d))
    cut = F.lit("2024-01-20").cast("timestamp")
    current = versions(e.filter(F.col("ts") < cut), "symbol", ["sector"], "ts", ["event_id"])
    new = e.filter(F.col("ts") >= cut).groupBy("symbol").agg(F.max_by("sector", F.struct("ts", "event_id")).alias("sector"), F.max("ts").alias("ts"))
    return scd2_apply(current, new, "symbol", ["sector"], "ts").select("symbol", "sector", "effective_from", "effective_to", "is_current")


def dim_04_merged(spark, d):
    """The same as a table in buckets of the key: a batch rewrites the buckets of the keys it has."""
    e = events(Tables(spark, d))
    cut = F.lit("2024-01-20").cast("timestamp")
    path = sinks.scratch(spark, "versions")
    commits.rebuild(versions(e.filter(F.col("ts") < cut), "symbol", ["sector"], "ts", ["event_id"]), path, commits.bucket_of("symbol"))
    new = e.filter(F.col("ts") >= cut).groupBy("symbol").agg(F.max_by("sector", F.struct("ts", "event_id")).alias("sector"), F.max("ts").alias("ts"))
    commits.merge_versions(new, path, "symbol", ["sector"], "ts")
    return commits.read(spark, path).select("symbol", "sector", "effective_from", "effective_to", "is_current")


def dim_06_security(spark, d):
    """Current members with keys, and the unknown member with key -1."""
    s = Tables(spark, d).securities()
    unknown = spark.range(1).select(F.lit(-1).cast("long").alias("security_key"), F.lit("UNKNOWN").alias("symbol"), F.lit(None).cast("string").alias("sector"))
    n = F.regexp_extract("symbol", r"(\d+)", 1).cast("long")
    return s.select(n.alias("security_key"), "symbol", "sector").unionByName(unknown)


def dim_07_current(spark, d):
    v = versions(events(Tables(spark, d)), "symbol", ["sector"], "ts", ["event_id"])
    return current(v, "symbol").select("symbol", "sector", "effective_from")


def prj_01_quotes(spark, d):
    """A quote service's fields of each brand, made of its parts, under the serving table's names."""
    mean, least = F.avg("p_retailprice"), F.min("p_name")
    p = Tables(spark, d).read("part").groupBy(F.col("p_brand").alias("symbol")).agg(
        *(F.concat(least, F.lit(f" {c}")).alias(c) for c in QUOTE_TEXTS), *(F.round(mean * (i + 1), 4).alias(c) for i, c in enumerate(QUOTE_NUMBERS))
    )
    return p.select("symbol", *quoted_fields())


def jn_04_valid_at(spark, d):
    t = Tables(spark, d)
    v = versions(events(t), "symbol", ["sector"], "ts", ["event_id"])
    days = t.read("events").select(F.col("user_id").cast("string").alias("symbol"), F.to_date("ts").alias("date")).distinct()
    return valid_at(days, v.select("symbol", "sector", "effective_from", "effective_to"), "symbol", "date").select("symbol", "date", "sector", "effective_from")


def fct_02_fundamentals(spark, d):
    t = Tables(spark, d)
    out = fundamentals_fact(t.bars().select("symbol", "date"), known(t).select("symbol", "filed", "net_income", "roe"), None, None)
    return r4(out, ["symbol", "date", "filed"], "net_income, roe")


def fct_02_fallback(spark, d):
    """Without a history: each brand's latest known row, dated with the last session of the bars."""
    t = Tables(spark, d)
    last = t.prices.agg(F.max("date").alias("_last"))
    newest = latest_per_key(known(t), ["symbol"], F.col("filed").desc()).select("symbol", "filed", "net_income", "roe").crossJoin(F.broadcast(last))
    out = fundamentals_fact(t.prices.select("symbol", "date"), None, newest, F.col("_last"))
    return r4(out, ["symbol", "date", "filed"], "net_income, roe")


def dim_01_calendar(spark, d):
    """The calendar of the whole years that have bars, with the symbols that traded on each day."""
    b = Tables(spark, d).bars()
    span = b.agg(F.trunc(F.min("date"), "year").alias("a"), F.make_date(F.year(F.max("date")), F.lit(12), F.lit(31)).alias("b"))
    traded = b.groupBy("date").agg(F.count("*").alias("n_symbols"), F.sum("volume").alias("volume"))
    return cal.calendar_of(span.select(F.explode(F.sequence("a", "b")).alias("date"))).join(traded, "date", "left")


def dim_02_split_days(spark, d):
    t = Tables(spark, d)
    span = t.bars().agg(F.min("date").alias("a"), F.max("date").alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("date"))
    out = cal.with_splits(days, t.raw_prices().filter("split_ratio > 0").select("symbol", "date"))
    return out.select("date", "is_split_day", F.array_join("split_symbols", ",").alias("split_symbols"))


def jn_20_drill_across(spark, d):
    t = Tables(spark, d)
    b = t.bars().join(t.securities().select("symbol", "sector"), "symbol").join(cal.calendar(spark, "1995-01-01", "2002-12-31").select("date", "quarter", "year", "is_session"), "date")
    return b.groupBy("sector", "year", "quarter").agg(F.count_if("is_session").alias("sessions"), F.sum("volume").alias("volume"), F.round(F.avg("close"), 4).alias("avg_close"))


def jn_16_exists(spark, d):
    t = Tables(spark, d)
    tracked = t.read("orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("_t", F.lit(True))
    return t.read("customer").join(tracked, "c_custkey", "left").select("c_custkey", F.coalesce("_t", F.lit(False)).alias("tracked"))


def jn_21_optional(spark, d):
    """Nations with the optional scores of their customers, once with that side (for nations of even number) and once without it."""
    t = Tables(spark, d)
    n = t.read("nation").select("n_nationkey")
    scores = t.read("customer").filter("c_nationkey % 2 = 0").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.round(F.avg("c_acctbal"), 4).alias("score"), F.min("c_mktsegment").alias("label"))
    types = {"score": "double", "label": "string"}
    both = [with_optional(n, right, ["n_nationkey"], types).withColumn("side", F.lit(name)) for name, right in (("there", scores), ("absent", None))]
    return both[0].unionByName(both[1])


def gld_14_disclosures(spark, d):
    x = Tables(spark, d).disclosures().withColumn("type", F.create_map(*[F.lit(v) for kv in _TYPES.items() for v in kv])[F.col("raw_type")])
    x = x.filter("symbol is not null and transaction_date is not null and type in ('purchase', 'sale')").withColumn("mid", mid_amount(F.col("amount")))
    return x.groupBy("symbol", "office", "type", "owner").agg(
        F.max("transaction_date").alias("last"), F.round(F.avg(F.datediff("disclosure_date", "transaction_date")), 4).alias("lag_days"), F.count("*").alias("n"), F.sum("mid").alias("mid_total")
    )


def ag_02_pivot(spark, d):
    f = Tables(spark, d).facts().filter("form = '10-K' and taxonomy = 'us-gaap'")
    return f.groupBy("symbol", "fiscal_year").pivot("tag", ["Revenues", "NetIncomeLoss", "Assets"]).agg(F.max("value"))


def ag_04_median(spark, d):
    o = Tables(spark, d).read("orders")
    total, closed = F.col("o_totalprice"), F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    places = exact_quantiles(o, ["o_orderpriority"], {"median": (total, 0.5), "median_f": (closed, 0.5), "p10": (total, 0.1)})
    counts = o.groupBy("o_orderpriority").agg(F.count_if(F.col("o_orderstatus") == "O").alias("n_open"), F.countDistinct("o_custkey").alias("customers"))
    return r4(places.join(counts, "o_orderpriority"), ["o_orderpriority", "n_open", "customers"], "median, median_f, p10")


def ag_05_approximate(spark, d):
    """Approximate quarters; with an accuracy above the rows of a group they are exact."""
    o = Tables(spark, d).read("orders")
    q = lambda p: F.percentile_approx("o_totalprice", F.lit(p), 1_000_000)
    return o.groupBy("o_orderpriority").agg(q(0.25).alias("q25"), q(0.75).alias("q75"))


def ag_05_sketches(spark, d):
    """Quarters from sketches kept by day and merged, and from one sketch of all: whether their exact ranks are within half a hundredth."""
    o = Tables(spark, d).read("orders").withColumn("day", F.to_date("o_orderdate"))
    days = sinks.stored(sketched(o, ["o_orderpriority", "day"], "o_totalprice"), "sketches")
    quarters = {"q25": 0.25, "q75": 0.75}
    out = None
    for kind, s in (("merged", merged(days, ["o_orderpriority"])), ("whole", sketched(o, ["o_orderpriority"], "o_totalprice"))):
        found = sinks.stored(approximate(s, quarters).drop("sketch"), "quarters")
        ranks = o.join(F.broadcast(found), "o_orderpriority").groupBy("o_orderpriority").agg(
            F.first("n").alias("n"), *((F.abs(F.avg((F.col("o_totalprice") <= F.col(q)).cast("double")) - p) <= 0.005).alias(f"{q}_within") for q, p in quarters.items())
        )
        one = ranks.withColumn("kind", F.lit(kind))
        out = one if out is None else out.unionByName(one)
    return out


def wn_03_whole_table(spark, d):
    """Percent rank of all orders by price, those without one last, without bringing them together."""
    o = Tables(spark, d).read("orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"))
    return r4(global_ranks(o, F.col("price"), ascending=False), ["o_orderkey", "global_rank"], "price, global_percent_rank", 8)


def ag_09_strings(spark, d):
    n = Tables(spark, d).read("nation")
    return n.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ", ").alias("names"), F.count("*").alias("n")).filter("n > 1")


def ag_18_correlation(spark, d):
    li = Tables(spark, d).read("lineitem")
    return li.groupBy("l_returnflag").agg(F.round(F.corr("l_quantity", "l_extendedprice"), 4).alias("corr"), F.round(F.covar_samp("l_quantity", "l_discount"), 4).alias("covar"), F.round(F.var_samp("l_quantity"), 4).alias("var"))


def wn_16_deciles(spark, d):
    c = Tables(spark, d).read("customer")
    return c.select("c_custkey", bucket([F.col("c_acctbal"), F.col("c_custkey")], ["c_mktsegment"]).alias("decile"))


def wn_17_carried(spark, d):
    e = Tables(spark, d).read("events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return e.select("event_id", F.round(carried(F.when(F.col("event_type") == "purchase", F.col("value")), w), 4).alias("last_purchase"))


def tk_01_top(spark, d):
    o = Tables(spark, d).read("orders")
    return o.orderBy(F.col("o_totalprice").desc_nulls_last(), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


def st_02_freshness_union(spark, d):
    t = Tables(spark, d)
    one = lambda df, c, n: df.agg(F.lit(n).alias("source"), F.to_date(F.max(c)).alias("latest"), F.count("*").alias("n"))
    return one(t.bars(), "date", "prices").unionByName(one(t.read("events"), "ts", "events")).unionByName(one(t.read("orders"), "o_orderdate", "orders"))


def st_03_sets(spark, d):
    o = Tables(spark, d).read("orders")
    a = o.filter("o_orderstatus = 'F'").select("o_custkey").distinct()
    b = o.filter("o_orderpriority = '1-URGENT'").select("o_custkey").distinct()
    tag = lambda df, n: df.select("o_custkey", F.lit(n).alias("side"))
    return tag(a.intersect(b), "both").unionByName(tag(a.exceptAll(b), "left")).unionByName(tag(b.exceptAll(a), "right"))


def fn_json_props(spark, d):
    e = Tables(spark, d).read("events")
    return e.select("event_id", F.from_json("props", "k long")["k"].alias("k"), F.to_json(F.struct("event_type", "user_id")).alias("json"))


def qa_01_freshness(spark, d):
    t = Tables(spark, d)
    latest = t.bars().groupBy("symbol").agg(F.max("date").alias("last_date"))
    n = F.regexp_extract("symbol", r"(\d+)", 1).cast("int")
    session = F.lit("2001-10-28").cast("date")
    return qa.freshness(latest, t.securities().select("symbol", (n % 10 == 0).alias("critical")), session)


def qa_05_null_shares(spark, d):
    b = Tables(spark, d).bars().withColumn("close", F.when(F.dayofmonth("date") > 3, F.col("close"))).select("symbol", "date", "close", "volume")
    return qa.null_shares(b).withColumn("null_share", F.round("null_share", 6))


def qa_10_price_checks(spark, d):
    p = Tables(spark, d).landed_prices().withColumn("_source_event_ts", F.col("date").cast("timestamp"))
    return qa.price_checks(p, ["symbol", "date"])


def qa_10_observed(spark, d):
    """The same checks counted while the prices are landed, which they stop, and of the first run alone, which they let pass."""
    p = Tables(spark, d).landed_prices().withColumn("_source_event_ts", F.col("date").cast("timestamp"))
    out = []
    for name, rows in (("both", p), ("first", p.filter("_run_id = 'run-1'"))):
        path = sinks.scratch(spark, "landed")
        counts = qa.land_checked(rows, path, ["symbol", "date"], F.year("date"))
        landed = commits.read(spark, path).count() if commits.versions(spark, path) else 0
        out += [(name, check, n) for check, n in counts.items()] + [(name, "landed", landed)]
    return spark.createDataFrame(out, "run string, check string, failures long")


def jn_20_one_year(spark, d):
    """Two facts of months across the calendar, of one year alone: only that year's months are read."""
    t = Tables(spark, d)
    days = cal.calendar(spark, "1995-01-01", "2002-12-31").filter("year = 1997").select("date", "quarter", "is_session")
    traded = star.by_month(t.bars().select("symbol", "date", "close", "volume"), "date", "market")
    ordered = star.by_month(t.read("orders").select(F.to_date("o_orderdate").alias("date"), "o_totalprice"), "date", "orders")
    market = star.on_days(traded, days).groupBy("quarter").agg(F.count_if("is_session").alias("in_session"), F.sum("volume").alias("volume"), F.round(F.avg("close"), 4).alias("avg_close"))
    orders = star.on_days(ordered, days).groupBy("quarter").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("value"))
    return market.join(orders, "quarter", "full_outer")


def qa_04_shape(spark, d):
    """Prices hold what is expected of them but for an adjusted close."""
    return qa.shape(Tables(spark, d).bars(), ["symbol", "date", "open", "high", "low", "close", "volume", "adj_close"])


def qa_03_completed_session(spark, d):
    return Tables(spark, d).read("events").select("event_id", qa.completed_session(F.col("ts")).alias("session"))


def str_01_dedupe(spark, d):
    e = streams.read_files(spark, d, "events")
    return streams.run(streams.deduplicated(e, "event_id", "ts"), "dedupe").select("event_id", "user_id", "event_type", "value")


def str_02_ohlc(spark, d):
    """Daily bars of a stream, merged into a table of months."""
    path = sinks.scratch(spark, "ohlc")
    bars = streams.ohlc(streams.read_files(spark, d, "events"), "event_type", "ts", "value").withColumn("start", F.to_date("start"))
    streams.run_keyed(bars, path, ["event_type", "start"], F.date_format("start", "yyyy-MM"), sinks.scratch(spark, "ohlc-state"))
    return commits.read(spark, path)


def str_03_hysteresis(spark, d):
    return streams.run(streams.in_position(streams.read_files(spark, d, "events"), "user_id", "ts", "value", 60.0, 20.0), "hysteresis")


QUERIES = {k: v for k, v in globals().items() if k[:4] in ("src_", "snk_", "prj_", "dim_", "fct_", "gld_", "str_") or k[:3] in ("jn_", "ag_", "wn_", "tk_", "st_", "fn_", "qa_")}

_D = LINES
_NUM = "regexp_extract(symbol, '(\\d+)', 1)::INT"
_AS_FILED = f"""f1 AS (SELECT symbol, y, unnest(['Revenues', 'SalesRevenueNet', CASE WHEN y % 2 = 0 THEN 'RevenueFromContractWithCustomerExcludingAssessedTax' END,
    CASE WHEN {_NUM} % 3 = 0 THEN 'CostOfGoodsSold' ELSE 'CostOfRevenue' END, 'NetIncomeLoss', 'EntityCommonStockSharesOutstanding', 'Assets',
    CASE WHEN {_NUM} % 4 = 0 THEN 'StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest' ELSE 'StockholdersEquity' END]) AS tag,
    unnest([rev, round(rev * 0.9, 4), round(rev * 0.98, 4), cost, ni, sh, ast, eq]::DOUBLE[]) AS value FROM fy),
f2 AS (SELECT *, '10-K' AS form, 45 AS days FROM f1 WHERE tag IS NOT NULL UNION ALL SELECT symbol, y, tag, round(value * 1.01, 4), '10-K/A', 410 FROM f1 WHERE tag = 'Revenues'),
af AS (SELECT *, CASE WHEN tag LIKE 'Entity%' THEN 'dei' ELSE 'us-gaap' END AS taxonomy,
  CASE WHEN tag NOT LIKE 'Entity%' AND tag NOT LIKE 'Stock%' AND tag <> 'Assets' THEN make_date(y, 1, 1) END AS start_date FROM f2)"""
_DISC = """di AS (SELECT c_mktsegment AS symbol, c_nationkey AS office, o_orderpriority[1] AS owner, o_orderstatus AS raw_type, o_totalprice AS amount, o_orderdate::DATE AS transaction_date,
  m AS disclosure_date, o_orderkey AS id FROM orders JOIN customer ON o_custkey = c_custkey JOIN (SELECT l_orderkey, max(l_shipdate)::DATE AS m FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey)"""
_MID = """CASE WHEN amount < 1000 THEN 500 WHEN amount < 15000 THEN 8000 WHEN amount < 50000 THEN 32500 WHEN amount < 100000 THEN 75000 WHEN amount < 250000 THEN 175000
  WHEN amount < 500000 THEN 375000 WHEN amount < 1000000 THEN 750000 ELSE 1000000 END::DOUBLE"""
_VER = """ve AS (SELECT user_id::VARCHAR AS symbol, ts AS effective_from, event_type AS sector, lead(ts) OVER w AS effective_to FROM
  (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was FROM events {where}) WHERE was IS NULL OR was <> event_type WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""
_CAL0 = "c0 AS (SELECT d::DATE AS date, year(d)::INT AS y, month(d)::INT AS m, day(d)::INT AS dom, isodow(d)::INT - 1 AS dow FROM generate_series({a}, {b}, INTERVAL 1 DAY) t(d))"


def _calendar_sql(a: str, b: str) -> str:
    parts, last = [_CAL0.format(a=a, b=b)], "c0"
    for i, (name, e) in enumerate(cal.EASTER):
        parts.append(f"k{i} AS (SELECT *, {e.replace(' div ', ' // ')} AS {name} FROM {last})")
        last = f"k{i}"
    obs = lambda mm, dd: f"(m = {mm} AND (dom = {dd} OR (dom = {dd + 1} AND dow = 0) OR (dom = {dd - 1} AND dow = 4)))"
    nth = "ceil(dom / 7)"
    holiday = f"""(m = 1 AND (dom = 1 OR (dom = 2 AND dow = 0))) OR (m = 1 AND dow = 0 AND {nth} = 3 AND y >= 1998) OR (m = 2 AND dow = 0 AND {nth} = 3) OR date + 2 = make_date(y, em, ed)
  OR (m = 5 AND dow = 0 AND dom > 24) OR ({obs(6, 19)} AND y >= 2022) OR {obs(7, 4)} OR (m = 9 AND dow = 0 AND {nth} = 1) OR (m = 11 AND dow = 3 AND {nth} = 4) OR {obs(12, 25)}
  OR date::VARCHAR IN ({", ".join(f"'{x}'" for x in cal.ONE_OFF)})"""
    parts.append(f"c1 AS (SELECT *, dow < 5 AND NOT ({holiday}) AS is_session FROM {last})")
    parts.append("""cal AS (SELECT date, strftime(date, '%Y%m%d')::INT AS date_key, dayname(date) AS day_name, m AS month, quarter(date)::INT AS quarter, y AS year, last_day(date) = date AS is_month_end,
  last_day(date) = date AND m % 3 = 0 AS is_quarter_end, m = 12 AND dom = 31 AS is_year_end, is_session,
  is_session AND ((m = 11 AND dow = 4 AND dom BETWEEN 23 AND 29) OR (m = 12 AND dom = 24) OR (m = 7 AND dom = 3)) AS is_early_close,
  CASE WHEN is_session THEN count(*) FILTER (is_session) OVER (PARTITION BY y ORDER BY date) END AS session_of_year,
  CASE WHEN is_session THEN count(*) FILTER (is_session) OVER (PARTITION BY y, m ORDER BY date) END AS session_of_month,
  max(CASE WHEN is_session THEN date END) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_session,
  min(CASE WHEN is_session THEN date END) OVER (ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_session FROM c1)""")
    return ", ".join(parts)


_SCD2 = f"""WITH {_VER.format(where="WHERE ts < TIMESTAMP '2024-01-20'")}, n AS (SELECT user_id::VARCHAR AS symbol, arg_max(event_type, (ts, event_id)) AS sector, max(ts) AS ts FROM events WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY ALL),
j AS (SELECT coalesce(v.symbol, n.symbol) AS symbol, v.sector AS os, v.effective_from AS ofr, n.sector AS ns, n.ts AS nts, n.symbol IS NOT NULL AND (v.symbol IS NULL OR v.sector <> n.sector) AS ch, v.symbol IS NOT NULL AS had
  FROM (SELECT * FROM ve WHERE effective_to IS NULL) v FULL JOIN n ON v.symbol = n.symbol)
SELECT symbol, sector, effective_from, effective_to, false AS is_current FROM ve WHERE effective_to IS NOT NULL
UNION ALL SELECT symbol, os, ofr, CASE WHEN ch THEN nts END, NOT ch FROM j WHERE had UNION ALL SELECT symbol, ns, nts, NULL, true FROM j WHERE ch"""

SQL = {
    "src_01_prices": f"""WITH {BARS} SELECT symbol, date, open, high, low, close, volume, 'run-1' AS _run_id, 'files' AS _source_system, 'full' AS _load_type,
  date AS _source_event_ts, TIMESTAMP '2024-01-01' AS _ingest_ts FROM bars
  WHERE day(date) <> 13 AND date >= DATE '1996-01-01'""",
    "src_03_numbers": "SELECT c_custkey, CASE WHEN c_custkey % 50 <> 0 AND c_custkey % 51 <> 0 AND c_custkey % 52 <> 0 THEN c_acctbal END AS balance FROM customer",
    "src_04_series": """SELECT event_type AS series, ts::DATE AS date, count(*)::DOUBLE AS value, CASE event_type WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'views' ELSE 'sales' END AS name
  FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY ALL""",
    "src_05_factors": """WITH e AS (SELECT ts::DATE AS date, count(*) FILTER (event_type = 'click') AS mkt, count(*) FILTER (event_type = 'view') AS smb, count(*) FILTER (event_type = 'purchase') AS mom FROM events GROUP BY ALL)
  SELECT date, 'mkt' AS factor, mkt / 100 AS value FROM e WHERE date <= DATE '2024-01-20' UNION ALL SELECT date, 'smb', smb / 100 FROM e WHERE date <= DATE '2024-01-20'
  UNION ALL SELECT date, 'mom', mom / 100 FROM e WHERE date >= DATE '2024-01-10'""",
    "src_06_disclosures": f"""WITH {_DISC} SELECT id, CASE WHEN id % 11 <> 0 THEN symbol END AS symbol, CASE raw_type WHEN 'F' THEN 'purchase' WHEN 'O' THEN 'sale' WHEN 'P' THEN 'exchange' END AS type,
  transaction_date, {_MID} AS amount_mid FROM di""",
    "src_08_facts_json": f"""WITH {_D}, {FACTS}, {_AS_FILED} SELECT symbol, taxonomy, tag, CASE taxonomy WHEN 'dei' THEN 'shares' ELSE 'USD' END AS unit, start_date, make_date(y, 12, 31) AS end_date, value,
  y AS fiscal_year, 'FY' AS fiscal_period, form, make_date(y, 12, 31) + days AS filed FROM af""",
    "src_09_listings": r"""WITH s AS (SELECT *, translate(s_suppkey::VARCHAR, '0123456789', 'ABCDEFGHIJ') AS l FROM supplier),
  x AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 9 = 0 THEN l || '.W' ELSE l END AS symbol, CASE WHEN s_suppkey % 8 = 0 THEN s_name || ' Warrant' ELSE s_name END AS name,
    CASE WHEN s_suppkey % 7 = 0 THEN 'Y' ELSE 'N' END AS test_issue, CASE WHEN s_suppkey % 6 = 0 THEN 'Y' ELSE 'N' END AS etf FROM s)
  SELECT symbol, CASE WHEN k % 2 = 0 THEN name ELSE 'other' END AS name, test_issue, etf FROM x WHERE (k % 2 = 0 OR k % 3 = 0) AND test_issue = 'N' AND etf = 'N' AND regexp_matches(symbol, '^[A-Z]{1,5}$')
    AND (k % 3 = 0 AND k % 2 <> 0 OR k % 8 <> 0)""",
    "src_12_without_facts": f"WITH {BARS}, {FACTS} SELECT DISTINCT symbol FROM bars WHERE symbol NOT IN (SELECT symbol FROM silver WHERE year(end_date) >= 1996 AND value > 5e7)",
    "src_14_journal_defects": f"""WITH {LINES}, b AS (SELECT l_orderkey AS k, l_linenumber AS n, l_quantity AS q, CASE WHEN l_linenumber <> 3 THEN px END AS price, 'buy' AS side, l_linenumber = 7 AS seed FROM lines JOIN orders ON l_orderkey = o_orderkey),
  t AS (SELECT * FROM b UNION ALL SELECT k, n, floor(q / 2), price, 'sell', false FROM b WHERE n % 2 = 0 AND floor(q / 2) > 0)
  SELECT 'bad side' AS defect, count(*) AS n FROM t WHERE k % 17 = 0 UNION ALL SELECT 'bad quantity', count(*) FROM t WHERE k % 13 = 0""",
    "src_16_migrated": "SELECT p_brand AS symbol, CASE WHEN regexp_extract(p_brand, '(\\d+)', 1)::INT % 5 = 0 THEN 'New#' || regexp_extract(p_brand, '(\\d+)', 1) ELSE p_brand END AS current FROM part GROUP BY ALL",
    "snk_01_append": "SELECT n_nationkey, n_name, CASE WHEN n_nationkey >= 10 THEN n_regionkey END AS n_regionkey FROM nation",
    "snk_03_upsert": f"""WITH {BARS} SELECT symbol, date, open, high, low, volume, CASE WHEN (date - DATE '1970-01-01') % 7 = 0 THEN close * 1.5 ELSE close END AS close,
  CASE WHEN (date - DATE '1970-01-01') % 7 = 0 THEN 'run-2' ELSE 'run-1' END AS _run_id FROM bars""",
    "snk_04_replace": f"""WITH {BARS}, b AS (SELECT *, regexp_extract(symbol, '(\\d+)', 1)::INT AS n FROM bars), f AS (SELECT symbol, date, open, high, low, close + 1 AS close, volume FROM b WHERE n % 2 = 0 AND date >= DATE '2000-01-01')
  SELECT * FROM f UNION ALL SELECT symbol, date, open, high, low, close, volume FROM b WHERE symbol NOT IN (SELECT symbol FROM f)""",
    "snk_04_windows": f"""WITH {BARS}, b AS (SELECT *, date BETWEEN DATE '1997-03-01' AND DATE '1997-08-31' AS again, regexp_extract(symbol, '(\\d+)', 1)::INT % 3 <> 0 AS kept FROM bars),
  f AS (SELECT DISTINCT date_trunc('month', date) AS m FROM b WHERE again AND kept)
  SELECT symbol, date, open, high, low, CASE WHEN again THEN close + 1 ELSE close END AS close, volume FROM b WHERE date_trunc('month', date) NOT IN (SELECT m FROM f) OR again AND kept""",
    "snk_05_first_write": f"""WITH {BARS} SELECT symbol, date AS as_of_date, CASE WHEN date < DATE '1997-01-01' THEN close ELSE close * 2 END AS close, 'v1' AS methodology_version FROM bars""",
    "snk_07_trials": """SELECT r_regionkey + 1 AS trial, r_name AS variant FROM region UNION ALL
  SELECT (SELECT max(r_regionkey) + 1 FROM region) + row_number() OVER (ORDER BY n_name), n_name FROM nation WHERE n_nationkey < 3""",
    "dim_03_versions": f"WITH {_VER.format(where='')} SELECT symbol, sector, effective_from, effective_to, effective_to IS NULL AS is_current FROM ve",
    "dim_04_scd2_apply": _SCD2,
    "dim_04_merged": _SCD2,
    "dim_06_security": f"WITH {SEC} SELECT regexp_extract(symbol, '(\\d+)', 1)::BIGINT AS security_key, symbol, sector FROM sec UNION ALL SELECT -1, 'UNKNOWN', NULL",
    "jn_04_valid_at": f"""WITH {_VER.format(where='')}, dd AS (SELECT DISTINCT user_id::VARCHAR AS symbol, ts::DATE AS date FROM events)
  SELECT dd.symbol, dd.date, sector, effective_from FROM dd LEFT JOIN ve ON ve.symbol = dd.symbol AND effective_from::DATE < dd.date AND (effective_to IS NULL OR effective_to::DATE >= dd.date)
  QUALIFY row_number() OVER (PARTITION BY dd.symbol, dd.date ORDER BY effective_from DESC NULLS LAST) = 1""",
    "fct_02_fundamentals": f"WITH {BARS}, {KNOWN} SELECT b.symbol, b.date, k.filed, round(k.net_income, 4) AS net_income, round(k.roe, 4) AS roe FROM bars b ASOF LEFT JOIN known k ON k.symbol = b.symbol AND k.filed <= b.date",
    "dim_01_calendar": f"""WITH {BARS}, {_calendar_sql("(SELECT date_trunc('year', min(date)) FROM bars)", "(SELECT make_date(year(max(date)), 12, 31) FROM bars)")},
  n AS (SELECT date, count(*) AS n_symbols, sum(volume)::BIGINT AS volume FROM bars GROUP BY date) SELECT * FROM cal LEFT JOIN n USING (date)""",
    "dim_02_split_days": f"""WITH {RAW}, sp AS (SELECT date, string_agg(symbol, ',' ORDER BY symbol) AS s FROM raw WHERE split_ratio > 0 GROUP BY date),
  dd AS (SELECT unnest(generate_series((SELECT min(date) FROM bars), (SELECT max(date) FROM bars), INTERVAL 1 DAY))::DATE AS date)
  SELECT date, s IS NOT NULL AS is_split_day, s AS split_symbols FROM dd LEFT JOIN sp USING (date)""",
    "jn_20_drill_across": f"""WITH {BARS}, {SEC}, {_calendar_sql("DATE '1995-01-01'", "DATE '2002-12-31'")} SELECT sector, year, quarter, count(*) FILTER (is_session) AS sessions, sum(volume)::BIGINT AS volume, round(avg(close), 4) AS avg_close
  FROM bars JOIN sec USING (symbol) JOIN cal USING (date) GROUP BY ALL""",
    "jn_20_one_year": f"""WITH {BARS}, {_calendar_sql("DATE '1997-01-01'", "DATE '1997-12-31'")},
  m AS (SELECT quarter, count(*) FILTER (is_session) AS in_session, sum(volume)::BIGINT AS volume, round(avg(close), 4) AS avg_close FROM bars JOIN cal USING (date) GROUP BY quarter),
  o AS (SELECT quarter, count(*) AS orders, round(sum(o_totalprice), 2) AS value FROM orders JOIN cal ON cal.date = o_orderdate::DATE GROUP BY quarter)
  SELECT * FROM m FULL JOIN o USING (quarter)""",
    "jn_16_exists": "SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000) AS tracked FROM customer",
    "fct_02_fallback": f"""WITH {BARS}, {KNOWN} SELECT symbol, (SELECT max(date) FROM bars) AS date, filed, round(net_income, 4) AS net_income, round(roe, 4) AS roe FROM known
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY filed DESC) = 1""",
    "qa_04_shape": "SELECT 'not_empty' AS check, (SELECT count(*) > 0 FROM lineitem) AS ok UNION ALL SELECT 'has_' || c, c <> 'adj_close' FROM (SELECT unnest(['symbol', 'date', 'open', 'high', 'low', 'close', 'volume', 'adj_close']) AS c)",
    "dim_07_current": f"WITH {_VER.format(where='')} SELECT symbol, sector, effective_from FROM ve WHERE effective_to IS NULL",
    "prj_01_quotes": f"""SELECT p_brand AS symbol, {", ".join(f"min(p_name) || ' {c}' AS {snake_case(c)}" for c in QUOTE_TEXTS)},
  {", ".join(f"round(avg(p_retailprice) * {i + 1}, 4) AS {snake_case(c)}" for i, c in enumerate(QUOTE_NUMBERS))} FROM part GROUP BY p_brand""",
    "ag_05_approximate": "SELECT o_orderpriority, quantile_disc(o_totalprice, 0.25) AS q25, quantile_disc(o_totalprice, 0.75) AS q75 FROM orders GROUP BY ALL",
    "ag_05_sketches": """SELECT o_orderpriority, count(*) AS n, true AS q25_within, true AS q75_within, kind FROM orders, (SELECT unnest(['merged', 'whole']) AS kind)
  WHERE o_totalprice IS NOT NULL GROUP BY o_orderpriority, kind""",
    "wn_03_whole_table": """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders)
  SELECT o_orderkey, rank() OVER w AS global_rank, round(price, 8) AS price, round(percent_rank() OVER w, 8) AS global_percent_rank FROM o WINDOW w AS (ORDER BY price DESC NULLS LAST)""",
    "jn_21_optional": """WITH c AS (SELECT c_nationkey, round(avg(c_acctbal), 4) AS score, min(c_mktsegment) AS label FROM customer WHERE c_nationkey % 2 = 0 GROUP BY 1)
  SELECT n_nationkey, score, label, 'there' AS side FROM nation LEFT JOIN c ON c_nationkey = n_nationkey
  UNION ALL SELECT n_nationkey, NULL::DOUBLE, NULL::VARCHAR, 'absent' FROM nation""",
    "gld_14_disclosures": f"""WITH {_DISC} SELECT symbol, office, CASE raw_type WHEN 'F' THEN 'purchase' ELSE 'sale' END AS type, owner, max(transaction_date) AS last,
  round(avg(disclosure_date - transaction_date), 4) AS lag_days, count(*) AS n, sum({_MID}) AS mid_total FROM di WHERE raw_type IN ('F', 'O') GROUP BY ALL""",
    "ag_02_pivot": f"""WITH {_D}, {FACTS} SELECT symbol, y AS fiscal_year, rev AS "Revenues", ni AS "NetIncomeLoss", ast AS "Assets" FROM fy""",
    "ag_04_median": """SELECT o_orderpriority, round(median(o_totalprice), 4) AS median, round(median(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 4) AS median_f, round(quantile_cont(o_totalprice, 0.1), 4) AS p10,
  count(*) FILTER (o_orderstatus = 'O') AS n_open, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY ALL""",
    "ag_09_strings": "SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS names, count(*) AS n FROM nation GROUP BY ALL HAVING count(*) > 1",
    "ag_18_correlation": "SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 4) AS corr, round(covar_samp(l_quantity, l_discount), 4) AS covar, round(var_samp(l_quantity), 4) AS var FROM lineitem GROUP BY ALL",
    "wn_16_deciles": "SELECT c_custkey, ceil(row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) * 10 / count(*) OVER (PARTITION BY c_mktsegment))::INT - 1 AS decile FROM customer",
    "wn_17_carried": "SELECT event_id, round(last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id), 4) AS last_purchase FROM events",
    "tk_01_top": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 25",
    "st_02_freshness_union": f"""WITH {BARS} SELECT 'prices' AS source, max(date) AS latest, count(*) AS n FROM bars UNION ALL SELECT 'events', max(ts)::DATE, count(*) FROM events
  UNION ALL SELECT 'orders', max(o_orderdate)::DATE, count(*) FROM orders""",
    "st_03_sets": """WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
  SELECT o_custkey, 'both' AS side FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT o_custkey, 'left' FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
  UNION ALL SELECT o_custkey, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    "fn_json_props": """SELECT event_id, (props->>'$.k')::BIGINT AS k, '{"event_type":"' || event_type || '","user_id":' || user_id || '}' AS json FROM events""",
    "qa_01_freshness": f"""WITH {BARS}, l AS (SELECT symbol, max(date) AS last_date FROM bars GROUP BY symbol), e AS (SELECT DISTINCT p_brand AS symbol, regexp_extract(p_brand, '(\\d+)', 1)::INT % 10 = 0 AS critical FROM part),
  j AS (SELECT e.*, last_date, last_date IS NULL OR last_date < DATE '2001-10-28' AS stale FROM e LEFT JOIN l USING (symbol))
  SELECT symbol, critical, last_date, stale, CASE WHEN NOT stale THEN 'ok' WHEN critical THEN 'error' WHEN (SELECT avg(stale::INT) FROM j) > 0.02 THEN 'error' ELSE 'warn' END AS status FROM j""",
    "qa_05_null_shares": f"""WITH {BARS}, n AS (SELECT avg((day(date) <= 3)::INT) AS s FROM bars) SELECT 'close' AS "column", round(s, 6) AS null_share, s > 0.05 AS failed FROM n
  UNION ALL SELECT unnest(['symbol', 'date', 'volume']), 0.0, false""",
    "qa_10_price_checks": f"""WITH {BARS}, t AS (SELECT close, high, low, volume, date FROM bars UNION ALL SELECT close * 1.5, high, low, volume, date FROM bars WHERE (date - DATE '1970-01-01') % 7 = 0)
  SELECT 'empty' AS "check", 0::BIGINT AS failures UNION ALL SELECT 'high_below_low', count(*) FILTER (high < low) FROM t UNION ALL SELECT 'negative_volume', count(*) FILTER (volume < 0) FROM t
  UNION ALL SELECT 'close_outside', count(*) FILTER (close > high OR close < low) FROM t UNION ALL SELECT 'null_close', count(*) FILTER (close IS NULL) FROM t UNION ALL SELECT 'event_after_ingest', 0
  UNION ALL SELECT 'duplicate_keys', count(*) FROM bars WHERE (date - DATE '1970-01-01') % 7 = 0""",
    "qa_10_observed": f"""WITH {BARS}, t AS (SELECT 'first' AS part, close, high, low, volume, date FROM bars UNION ALL SELECT 'second', close * 1.5, high, low, volume, date FROM bars WHERE (date - DATE '1970-01-01') % 7 = 0),
  r AS (SELECT 'both' AS run, t.* FROM t UNION ALL SELECT 'first', t.* FROM t WHERE part = 'first'),
  c AS (SELECT run, count(*) FILTER (high < low) AS high_below_low, count(*) FILTER (volume < 0) AS negative_volume, count(*) FILTER (close > high OR close < low) AS close_outside,
    count(*) FILTER (close IS NULL) AS null_close, 0::BIGINT AS empty, 0::BIGINT AS event_after_ingest, count(*) FILTER (part = 'second') AS duplicate_keys, count(*) AS n FROM r GROUP BY run),
  w AS (SELECT run, high_below_low, negative_volume, close_outside, null_close, empty, event_after_ingest, duplicate_keys,
    CASE WHEN high_below_low + negative_volume + close_outside + null_close + duplicate_keys = 0 THEN n ELSE 0 END AS landed FROM c)
  UNPIVOT w ON high_below_low, negative_volume, close_outside, null_close, empty, event_after_ingest, duplicate_keys, landed INTO NAME "check" VALUE failures""",
    "qa_03_completed_session": """SELECT event_id, CASE WHEN (ts - INTERVAL 5 HOUR)::TIME >= TIME '16:30:00' THEN (ts - INTERVAL 5 HOUR)::DATE ELSE (ts - INTERVAL 5 HOUR)::DATE - 1 END AS session FROM events""",
    "str_01_dedupe": "SELECT event_id, user_id, event_type, value FROM events",
    "str_02_ohlc": """SELECT event_type, ts::DATE AS start, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS n FROM events GROUP BY ALL""",
    "str_03_hysteresis": """SELECT user_id, event_id, coalesce(last_value(CASE WHEN value >= 60 THEN true WHEN value < 20 THEN false END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id), false) AS inside FROM events""",
}
