"""Statement parsing, ratios, sparse filter, log gate, dedupe and as-of."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tickwise.functions.frames import densify_daily
from tickwise.operators import fundamentals as FU
from tickwise.sources.statements import parse_statements, report_dates


def _docs(spark, rows):
    """rows: (symbol, statement, [report dicts])"""
    return spark.createDataFrame(
        [(s, st, json.dumps({"quarterlyReports": reps})) for s, st, reps in rows],
        "symbol string, statement string, body string")


def _q(i):
    return ["2020-03-31", "2020-06-30", "2020-09-30", "2020-12-31", "2021-03-31",
            "2021-06-30", "2021-09-30", "2021-12-31", "2022-03-31", "2022-06-30"][i]


def test_json_bad_values(spark):
    docs = _docs(spark, [
        ("A", "income", [{"fiscalDateEnding": "2020-03-31", "totalRevenue": "100",
                          "netIncome": "None", "reportedCurrency": "USD"},
                         {"fiscalDateEnding": "not a date", "totalRevenue": "5"}]),
        ("A", "balance", []),
    ]).unionByName(spark.createDataFrame([("A", "cashflow", '{"other": 1}')],
                                         "symbol string, statement string, body string"))
    p = {(r["statement"], r["item"]): r["value"] for r in parse_statements(docs).collect()}
    assert p[("income", "totalRevenue")] == 100.0
    assert p[("income", "netIncome")] is None and p[("income", "reportedCurrency")] is None
    assert len(p) == 3   # bad-date report dropped, empty and malformed statements skipped


def test_null_ratio_threshold_is_strict(spark):
    reps = []
    for i in range(10):
        r = {"fiscalDateEnding": _q(i), "a": "1" if i < 3 else "None",
             "b": "1" if i < 2 else "None", "c": "7"}
        reps.append(r)
    long = parse_statements(_docs(spark, [("A", "income", reps)]))
    nr = {r["item"]: (r["null_frac"], r["kept"]) for r in FU.null_ratios(long).collect()}
    assert nr["a"] == (0.7, True) and nr["b"] == (0.8, False) and nr["c"] == (0.0, True)


def test_log_gate(spark):
    reps = [{"fiscalDateEnding": _q(0), "small": "1000000", "big": "1000001", "neg": "-5"},
            {"fiscalDateEnding": _q(1), "small": "3", "big": "10", "neg": "2000000"}]
    long = FU.log_scale(parse_statements(_docs(spark, [("A", "income", reps)])))
    v = {(r["item"], r["fiscal_date"].isoformat()): r["value"] for r in long.collect()}
    import math
    assert v[("small", _q(0))] == 1e6 and v[("small", _q(1))] == 3.0
    assert abs(v[("big", _q(0))] - math.log1p(1000001)) < 1e-12
    assert abs(v[("big", _q(1))] - math.log1p(10)) < 1e-12
    assert v[("neg", _q(0))] == -5.0


def test_ratios_only_within_statement_and_dedupe(spark):
    docs = _docs(spark, [
        ("A", "income", [{"fiscalDateEnding": _q(0), "netIncome": "None", "totalRevenue": "50"}]),
        ("A", "cashflow", [{"fiscalDateEnding": _q(0), "netIncome": "9",
                            "operatingCashflow": "4"}]),
        ("A", "balance", [{"fiscalDateEnding": _q(0), "totalAssets": "90"}]),
    ])
    p = parse_statements(docs)
    rat = {(r["statement"], r["item"]): r["value"]
           for r in FU.statement_ratios(p.where(F.col("item").isNotNull())).collect()}
    assert ("income", "ProfitMargin") in rat and rat[("income", "ProfitMargin")] is None
    assert not any(k[1] in ("ROA", "FreeCashFlowMargin") for k in rat)
    ded = FU.dedupe_items(p.where(F.col("item").isNotNull()))
    ni = [(r["statement"], r["value"]) for r in ded.where("item = 'netIncome'").collect()]
    assert ni == [("income", None)]   # income's item kept even though it is NULL


def test_asof_edges_and_null_quarter(spark):
    reps = [{"fiscalDateEnding": "2020-03-31", "x": "1"},
            {"fiscalDateEnding": "2020-06-30", "x": "None"},
            {"fiscalDateEnding": "2020-09-30", "x": "3"}]
    p = parse_statements(_docs(spark, [("A", "income", reps)]))
    long = p.where(F.col("item").isNotNull())
    f0 = dt.date(2020, 3, 31)
    last = dt.date(2020, 9, 30)
    probe = [f0 + dt.timedelta(days=89), f0 + dt.timedelta(days=90),
             dt.date(2020, 6, 30) + dt.timedelta(days=95),
             last + dt.timedelta(days=90), last + dt.timedelta(days=91)]
    bars = spark.createDataFrame([("A", d) for d in probe], "symbol string, date date")
    out = {r["date"]: r for r in FU.asof_fundamentals(bars, long, report_dates(p), ["x"]).collect()}
    assert probe[0] not in out                         # cut by the trim (P7)
    assert out[probe[1]]["x"] == 1.0                   # fiscal + 90 matched
    assert out[probe[2]]["x"] is None                  # NULL quarter stays NULL
    assert out[probe[3]]["x"] == 3.0                   # last fiscal + 90 matched
    assert out[probe[4]]["x"] is None                  # after that: NULL
    carry = {r["date"]: r for r in FU.asof_fundamentals(
        bars, long, report_dates(p), ["x"], carry_last=True).collect()}
    assert carry[probe[4]]["x"] == 3.0


def test_monthly_densify(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 1.0), (dt.date(2020, 2, 1), None),
                                (dt.date(2020, 3, 1), 3.0)], "date date, v double")
    out = densify_daily(df).toPandas().sort_values("date")
    assert len(out) == 61
    feb = out[(out.date >= dt.date(2020, 2, 1)) & (out.date < dt.date(2020, 3, 1))]
    assert feb.v.isna().all() and len(feb) == 29


def test_first_available_alias(spark):
    docs = _docs(spark, [("A", "balance", [{"fiscalDateEnding": _q(0), "totalLiabilities": "5",
                                            "totalShareholderEquity": "None"}]),
                         ("B", "balance", [{"fiscalDateEnding": _q(0), "totalLiab": "7",
                                            "totalLiabilities": "8"}])])
    fa = {(r["symbol"], r["canonical"]): (r["source_item"], r["value"])
          for r in FU.first_available(spark, parse_statements(docs)).collect()}
    assert fa[("A", "total_liab")] == ("totalLiabilities", 5.0)
    assert fa[("A", "equity")] == ("totalShareholderEquity", None)
    assert fa[("B", "total_liab")] == ("totalLiab", 7.0)


def test_cross_statement_ratios_option(spark):
    docs = _docs(spark, [
        ("A", "income", [{"fiscalDateEnding": _q(0), "netIncome": "10", "totalRevenue": "50"},
                         {"fiscalDateEnding": _q(1), "netIncome": "12", "totalRevenue": "60"}]),
        ("A", "balance", [{"fiscalDateEnding": _q(0), "totalAssets": "100"},
                          {"fiscalDateEnding": _q(1), "totalAssets": "120"}]),
    ])
    p = parse_statements(docs)
    plain = {r["item"] for r in FU.fundamentals_long(p).collect()}
    assert "ROA" not in plain and "ProfitMargin" in plain
    cross = {(r["item"], r["fiscal_date"].isoformat()): r["value"]
             for r in FU.fundamentals_long(p, cross_statement=True).collect()}
    assert cross[("ROA", _q(0))] == 0.1 and cross[("ROA", _q(1))] == 0.1
    assert ("FreeCashFlowMargin", _q(0)) not in cross
