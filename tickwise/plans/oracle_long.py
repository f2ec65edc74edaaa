"""DuckDB SQL of the queries of :mod:`tickwise.plans.catalog_long`, with plain
windows, a truncated convolution for the exponential means and ASOF JOIN."""

from __future__ import annotations

from .oracle_sql import (BARS, BARS_HOURLY, LABEL_CTES, MACRO_CTES, PRICE_OUT, VIXC, YLDC, dr, gated, price_ctes, rnd, select_rounded, win,
                         with_ctes)

BARS_MINUTE = """
mbars AS (
  SELECT 'ALL' AS symbol, date_trunc('minute', ts) AS date,
         first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
         first(value ORDER BY ts DESC, event_id DESC) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM events WHERE value IS NOT NULL GROUP BY date_trunc('minute', ts)
)"""


def extremes() -> str:
    from .catalog_long import EXTREME_ROWS as n, STOCHASTIC_ROWS as k
    w = win()
    return with_ctes(BARS_MINUTE) + f""",
a AS (
  SELECT *, close / NULLIF(max(close) {win(rows=n)}, 0) - 1 AS dd,
    {gated('min', 'low', k)} AS lo, {gated('max', 'high', k)} AS hi FROM mbars
),
b AS (SELECT *, min(dd) {win(rows=n)} AS mdd, (close - lo) / NULLIF(hi - lo, 0) * 100 AS pk FROM a),
c AS (SELECT *, {gated('avg', 'pk', 3)} AS pd FROM b),
d AS (SELECT symbol, date, lag(mdd, 1) {w} AS max_drawdown, lag(pk, 1) {w} AS stochastic_k, lag(pd, 1) {w} AS stochastic_d FROM c)
SELECT symbol, date, {rnd('max_drawdown')}, {rnd('stochastic_k')}, {rnd('stochastic_d')} FROM d"""


def _mean(x: str, alpha: float, adjust: bool) -> str:
    """Weighted sum over the rows whose weight a double can still show."""
    r = 1 - alpha
    first = "" if adjust else f"CASE WHEN j.rn = 1 THEN 1.0::DOUBLE ELSE {alpha}::DOUBLE END * "
    num = f"sum({first}j.{x} * pow({r}::DOUBLE, i.rn - j.rn))"
    return num + (f" / sum(pow({r}::DOUBLE, i.rn - j.rn))" if adjust else "")


def scans(rsi: int = 21, short: int = 21, long: int = 50, signal: int = 15) -> str:
    near = "FROM {0} i JOIN {0} j ON j.rn BETWEEN i.rn - {1} AND i.rn GROUP BY i.rn"
    w = "OVER (ORDER BY rn)"
    up = "OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return with_ctes(BARS_MINUTE) + f""",
g AS (
  SELECT symbol, date, volume,
         last_value(CASE WHEN minute(date) % 7 <> 0 THEN close END IGNORE NULLS) {up} AS close_filled FROM mbars
),
f AS (SELECT *, row_number() OVER (ORDER BY date) AS rn FROM g WHERE close_filled IS NOT NULL),
m AS (SELECT *, coalesce(close_filled - lag(close_filled) {w}, 0) AS move FROM f),
n AS (SELECT *, greatest(move, 0) AS gain, greatest(-move, 0) AS loss,
        sum(sign(move) * volume) OVER (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS o FROM m),
gl AS (SELECT i.rn, {_mean('gain', 1 / rsi, True)} AS g, {_mean('loss', 1 / rsi, True)} AS l {near.format('n', 900)}),
sl AS (SELECT i.rn, {_mean('close_filled', 1 / (1 + short), False)} - ({_mean('close_filled', 1 / (1 + long), False)}) AS macd
       {near.format('n', 2000)}),
sg AS (SELECT i.rn, {_mean('macd', 2 / (signal + 1), False)} AS sig {near.format('sl', 400)}),
x AS (
  SELECT n.*, sl.macd, sg.sig,
    CASE WHEN n.rn >= {rsi} THEN CASE WHEN g + l = 0 THEN NULL WHEN l = 0 THEN 100 ELSE 100 - 100 / (1 + g / l) END END AS r
  FROM n JOIN gl USING (rn) JOIN sl USING (rn) JOIN sg USING (rn)
),
y AS (
  SELECT symbol, date, close_filled, lag(o) {w} AS obv, lag(r) {w} AS rsi, lag(macd) {w} AS macd,
         lag(sig) {w} AS macd_signal, lag(macd - sig) {w} AS macd_indicator FROM x
  UNION ALL
  SELECT symbol, date, NULL, NULL, NULL, NULL, NULL, NULL FROM g WHERE close_filled IS NULL
)
SELECT symbol, date, {', '.join(rnd(c) for c in ('close_filled', 'obv', 'rsi', 'macd', 'macd_signal', 'macd_indicator'))} FROM y"""


REPORTS = """
reports AS (
  SELECT event_type AS symbol, max(ts) AS published_at, count(*) AS n_events, avg(value) AS mean_value
  FROM events WHERE value IS NOT NULL AND ts IS NOT NULL
  GROUP BY event_type, CAST(ts AS DATE), hour(ts) // 6
)"""


def build() -> dict[str, str]:
    q = {}
    q["bars_minute"] = with_ctes(BARS_MINUTE) + "\n" + select_rounded(
        "mbars", ["symbol", "date"], ["open", "high", "low", "close", "volume"])
    q["minute_price_features"] = with_ctes(BARS_MINUTE, price_ctes("mbars")) + "\n" + select_rounded(
        "price", ["symbol", "date"], PRICE_OUT)
    q["minute_extremes"] = extremes()
    q["minute_scans"] = scans()
    q["yearly_label_selected"] = with_ctes(BARS, LABEL_CTES) + f"""
SELECT symbol, date, CAST(year(date) AS INTEGER) AS year, {dr('threshold')} AS threshold,
       target_3m FROM labelled"""
    q["trade_price_quantile"] = with_ctes(BARS) + f"""
SELECT symbol, CAST(year(date) AS INTEGER) AS year, {rnd('quantile_cont(px, 0.1)', 'q10')},
       {rnd('quantile_cont(px, 0.5)', 'median')}, {rnd('quantile_cont(px, 0.6)', 'q60')}
FROM trades GROUP BY symbol, year(date)"""
    q["asof_reports"] = with_ctes(BARS_HOURLY, REPORTS) + f"""
SELECT b.symbol, b.date, {rnd('b.close', 'close')}, r.published_at, CAST(r.n_events AS DOUBLE) AS n_events, {rnd('r.mean_value', 'mean_value')}
FROM hbars b ASOF LEFT JOIN reports r ON b.symbol = r.symbol AND b.date >= r.published_at + INTERVAL 90 MINUTE"""
    vix = """
vix AS (
  SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) / 10000 AS value, day(CAST(o_orderdate AS DATE)) AS d
  FROM orders GROUP BY CAST(o_orderdate AS DATE)
)"""
    q["landed_series"] = with_ctes(vix) + f"""
SELECT 'VIX' AS series_id, date, {dr('CASE WHEN d % 7 <> 0 THEN value END')} AS value FROM vix
WHERE d % 10 <> 0 AND date BETWEEN DATE '1993-01-01' AND DATE '1996-12-31'"""
    q["landed_audit"] = with_ctes(vix) + """
SELECT count(*) AS n_lines, count(*) FILTER (WHERE d % 10 = 0) AS n_corrupt, CAST(0 AS BIGINT) AS n_undated,
       count(*) FILTER (WHERE d % 10 <> 0 AND d % 7 = 0) AS n_missing,
       min(date) FILTER (WHERE d % 10 <> 0) AS first_date, max(date) FILTER (WHERE d % 10 <> 0) AS last_date FROM vix"""
    q["statement_audit"] = """
WITH s AS (
  SELECT DISTINCT r_name AS symbol, date_trunc('quarter', o_orderdate) AS quarter FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)
SELECT symbol || '/' || name AS symbol, statement, reason
FROM s, (VALUES ('cut', 'corrupt'), ('missing', 'corrupt'), ('empty', 'no reports'), ('undated', 'no dated report')) f(name, reason),
     (VALUES ('income'), ('balance'), ('cashflow')) t(statement)"""
    q["macro_without_yields"] = with_ctes(MACRO_CTES) + "\n" + select_rounded("vixf", ["date"], VIXC).replace(
        " FROM", "".join(f", CAST(NULL AS DOUBLE) AS {c}" for c in YLDC) + " FROM", 1)
    q["features_incremental"] = with_ctes(BARS, price_ctes()) + f""",
newest AS (SELECT max(year(date)) AS y FROM price)
SELECT symbol, date, {dr('CASE WHEN year(date) = y THEN -close ELSE close END')} AS close,
       {', '.join(rnd(c) for c in PRICE_OUT)} FROM price, newest"""
    return q
