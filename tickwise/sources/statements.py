"""Quarterly financial statements as JSON documents.

A statement document is ``{"quarterlyReports": [{"fiscalDateEnding": ..,
"<item>": "<number or text>", ...}, ...]}`` -- every value a string, absent
numbers written as non-numeric text such as ``"None"``.  Documents are rows
``(symbol, statement, body)`` in a DataFrame (read from JSON lines, a table,
or built below), parsed with ``from_json`` into the long form
``(symbol, statement, fiscal_date, item, value)``.  Long form keeps
data-dependent columns (which items a payload has) as rows, so nothing has
to be collected to decide the schema.

:func:`statements_from_orders` derives such documents from the landed
``orders`` table: one document per (customer region, statement, quarter).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import det_round
from ..functions.joins import broadcast_if_small
from .tables import read_table

# Statement names in precedence order (first wins on
# duplicate items, as the statements are concatenated in this order).
STATEMENTS = ("income", "balance", "cashflow")

REPORTS_SCHEMA = T.StructType([
    T.StructField("quarterlyReports", T.ArrayType(T.MapType(T.StringType(), T.StringType())))
])
DATE_KEY = "fiscalDateEnding"

# Items of the derived documents: (statement, item, aggregate over the
# orders of one region and quarter).  p = order total, st = status,
# pr = priority, bal = customer account balance.
ITEM_SPECS = (
    ("income", "totalRevenue", "sum(p)"),
    ("income", "netIncome", "sum(p) FILTER (WHERE st = 'F')"),
    ("income", "costOfRevenue", "sum(p) FILTER (WHERE st = 'O')"),
    ("income", "grossProfit", "sum(p) FILTER (WHERE st <> 'O')"),
    ("income", "orderCount", "CAST(count(*) AS DOUBLE)"),
    ("income", "extraordinaryItems", "sum(p) FILTER (WHERE p > 498500)"),
    ("balance", "totalAssets", "sum(p + greatest(bal, 0))"),
    ("balance", "totalLiabilities", "sum(p) FILTER (WHERE pr = '1-URGENT')"),
    ("balance", "totalShareholderEquity", "sum(p) FILTER (WHERE pr <> '1-URGENT')"),
    ("balance", "totalCurrentAssets", "sum(p) FILTER (WHERE pr IN ('1-URGENT', '2-HIGH'))"),
    ("balance", "totalCurrentLiabilities", "sum(bal)"),
    ("balance", "treasuryStock", "sum(p) FILTER (WHERE p > 499000)"),
    ("cashflow", "operatingCashflow", "sum(p) FILTER (WHERE st <> 'O')"),
    ("cashflow", "netIncome", "sum(p) FILTER (WHERE st = 'F' AND pr <> '1-URGENT')"),
    ("cashflow", "capitalExpenditures", "max(p) FILTER (WHERE pr = '5-LOW')"),
    ("cashflow", "dividendPayout", "sum(p) FILTER (WHERE p > 498500 AND pr <> '5-LOW')"),
)
TEXT_ITEMS = (("income", "reportedCurrency", "USD"),)


def statements_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(symbol, statement, body)`` documents, one per region, statement and
    quarter (quarter-end fiscal date), with numbers rendered as strings and
    missing numbers as ``"None"``.  One grouped aggregate over orders; the
    dimension tables region (5 rows) and nation (25 rows) are broadcast, the
    customer mapping only after a count shows it is small."""
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority")
    nr = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    cr = broadcast_if_small(cust.join(F.broadcast(nr), cust.c_nationkey == nr.n_nationkey),
                            cust)
    o = orders.join(cr, orders.o_custkey == cr.c_custkey).select(
        F.col("r_name").alias("symbol"),
        F.last_day(F.add_months(F.trunc(F.to_date("o_orderdate"), "quarter"), 2)).alias("fd"),
        F.col("o_totalprice").alias("p"), F.col("o_orderstatus").alias("st"),
        F.col("o_orderpriority").alias("pr"), F.col("c_acctbal").alias("bal"))
    # statements report currency amounts in cents
    aggs = [det_round(F.expr(expr), 2, sig=None).alias(f"{st}__{item}")
            for st, item, expr in ITEM_SPECS]
    q = o.groupBy("symbol", "fd").agg(*aggs)

    def body(statement: str):
        kv = [F.lit(DATE_KEY), F.date_format("fd", "yyyy-MM-dd")]
        for st, item, _ in ITEM_SPECS:
            if st == statement:
                kv += [F.lit(item), F.coalesce(F.col(f"{st}__{item}").cast("string"), F.lit("None"))]
        for st, item, text in TEXT_ITEMS:
            if st == statement:
                kv += [F.lit(item), F.lit(text)]
        return F.to_json(F.struct(F.array(F.create_map(*kv)).alias("quarterlyReports")))

    docs = q.select("symbol", "fd", F.array(*[
        F.struct(F.lit(s).alias("statement"), body(s).alias("body")) for s in STATEMENTS
    ]).alias("_d")).select("symbol", "fd", F.explode("_d").alias("_d"))
    return docs.select("symbol", F.col("_d.statement").alias("statement"),
                       F.col("_d.body").alias("body"))


def read_statements(spark: SparkSession, path: str) -> DataFrame:
    """Landed statement files as documents ``(symbol, statement, body)``: one
    JSON document a file, named ``<symbol>_<statement>.json``."""
    files = spark.read.format("text").option("wholetext", "true").load(path)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.+)_([^_]+)\.json$", 0)
    return files.where(name != "").select(
        F.regexp_extract("_metadata.file_name", r"^(.+)_([^_]+)\.json$", 1).alias("symbol"),
        F.regexp_extract("_metadata.file_name", r"^(.+)_([^_]+)\.json$", 2).alias("statement"),
        F.col("value").alias("body"))


def unreadable_statements(docs: DataFrame) -> DataFrame:
    """``(symbol, statement, reason)`` of the documents that yield no rows:
    ``corrupt`` (missing or not JSON), ``no reports`` or ``no dated report``."""
    schema = T.StructType([*REPORTS_SCHEMA.fields, T.StructField("_corrupt_record", T.StringType())])
    read = F.from_json("body", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    reports = F.col("_d.quarterlyReports")
    dated = F.exists(reports, lambda m: F.try_to_date(m.getItem(DATE_KEY), "yyyy-MM-dd").isNotNull())
    reason = (F.when(F.col("_d").isNull() | F.col("_d._corrupt_record").isNotNull(), "corrupt")
              .when(F.coalesce(F.size(reports), F.lit(0)) < 1, "no reports")
              .when(~F.coalesce(dated, F.lit(False)), "no dated report"))
    return (docs.select("symbol", "statement", read.alias("_d"))
            .select("symbol", "statement", reason.alias("reason")).where("reason is not null"))


def parse_statements(docs: DataFrame) -> DataFrame:
    """Parse statement documents into ``(symbol, statement, fiscal_date,
    item, value)``.

    * F3: ``fiscalDateEnding`` -> ``try_to_date``; reports without a valid
      date are dropped; of duplicate reports for one date the last wins.
    * F2: every other value -> ``try_cast`` to double; text such as
      ``"None"`` / ``"USD"`` becomes NULL, as do NaN and infinities.
    * A document without ``quarterlyReports`` (or unparsable) yields no rows;
      a dated report without items yields one row with ``item`` NULL, so its
      date still belongs to the statement's index.
    """
    parsed = docs.select(
        "symbol", "statement", F.xxhash64("body").alias("_doc"),
        F.from_json("body", REPORTS_SCHEMA).getField("quarterlyReports").alias("_r"))
    reports = parsed.select("symbol", "statement", "_doc",
                            F.posexplode("_r").alias("_pos", "_m"))
    reports = reports.withColumn(
        "fiscal_date", F.try_to_date(F.col("_m").getItem(DATE_KEY), "yyyy-MM-dd"))
    reports = reports.where(F.col("fiscal_date").isNotNull())
    last = Window.partitionBy("symbol", "statement", "fiscal_date").orderBy(
        F.col("_pos").desc(), F.col("_doc").desc())
    reports = reports.withColumn("_rn", F.row_number().over(last)).where("_rn = 1")
    long = reports.select("symbol", "statement", "fiscal_date",
                          F.explode_outer(F.map_filter("_m", lambda k, v: k != F.lit(DATE_KEY)))
                          .alias("item", "_v"))
    v = F.col("_v").try_cast("double")
    bad = F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    return long.select("symbol", "statement", "fiscal_date", "item",
                       F.when(~bad, v).alias("value"))


def report_dates(docs_or_long: DataFrame) -> DataFrame:
    """Distinct ``(symbol, fiscal_date)`` over all statements (the index of the
    concatenated statements)."""
    return docs_or_long.select("symbol", "fiscal_date").distinct()
