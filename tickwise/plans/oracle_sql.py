"""Independent DuckDB formulations of every registered query.

Each entry is one SQL statement over the landed tables (pre-registered as
views).  They are written from the operator definitions, not generated from
the Spark plans: windows are spelled out frame by frame, smoothing is a
recursive CTE (``y_t = a*x_t + (1-a)*y_{t-1}``) instead of the closed form
used on Spark, the as-of join is a correlated lookup, and so on.

Doubles are rounded to 6 decimals on both sides so different summation
orders do not change the value hash.  Divisions use ``NULLIF(d, 0)``
because DuckDB returns ``inf`` where Spark's ``try_divide`` returns NULL.
"""

from __future__ import annotations

R = 6  # rounding digits


def dr(expr: str, digits: int = R, sig: int | None = 9) -> str:
    """Half-up rounding from IEEE operations only (same bits as on Spark):
    ``digits`` decimals, ``sig`` significant digits for large magnitudes."""
    if sig is None:
        return f"(floor(({expr}) * 1e{digits} + 0.5::DOUBLE) / 1e{digits})"
    big = 10 ** (sig - digits - 1)
    sc = (f"pow(10.0::DOUBLE, CASE WHEN abs({expr}) >= {big} "
          f"THEN least({digits}, {sig - 1} - floor(log10(abs({expr})))) ELSE {digits} END)")
    return f"(floor(({expr}) * {sc} + 0.5::DOUBLE) / {sc})"


def rnd(expr: str, alias: str | None = None, digits: int = R) -> str:
    return f"{dr(expr, digits)} AS {alias or expr}"


def win(order="date", key="symbol", rows: int | None = None, frame: str | None = None) -> str:
    part = f"PARTITION BY {key} ORDER BY {order}" if key else f"ORDER BY {order}"
    if rows is not None:
        return f"OVER ({part} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    if frame is not None:
        return f"OVER ({part} {frame})"
    return f"OVER ({part})"


def gated(agg: str, x: str, k: int, min_periods: int | None = None, key="symbol",
          order="date") -> str:
    mp = k if min_periods is None else min_periods
    w = win(order, key, rows=k)
    return f"CASE WHEN count({x}) {w} >= {mp} THEN {agg}({x}) {w} END"


# --------------------------------------------------------------------- bars
BARS = """
trades AS (
  SELECT r.r_name AS symbol, CAST(l.l_shipdate AS DATE) AS date,
         l.l_extendedprice / NULLIF(l.l_quantity, 0) AS px, l.l_quantity AS qty,
         l.l_orderkey, l.l_linenumber, l.l_partkey
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
bars AS (
  SELECT symbol, date,
         first(px ORDER BY l_orderkey, l_linenumber, l_partkey, px) AS open,
         max(px) AS high, min(px) AS low,
         first(px ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, px DESC) AS close,
         CAST(sum(qty) AS DOUBLE) AS volume
  FROM trades WHERE px IS NOT NULL GROUP BY symbol, date
)"""

BARS_HOURLY = """
hbars AS (
  SELECT event_type AS symbol, date_trunc('hour', ts) AS date,
         first(value ORDER BY ts, event_id) AS open,
         max(value) AS high, min(value) AS low,
         first(value ORDER BY ts DESC, event_id DESC) AS close,
         CAST(count(*) AS DOUBLE) AS volume
  FROM events WHERE value IS NOT NULL GROUP BY event_type, date_trunc('hour', ts)
)"""


def price_ctes(src: str = "bars", key: str = "symbol", order: str = "date") -> str:
    """CTEs p1..p4 computing the 17 price features from ``src``."""
    w = win(order, key)
    return f"""
p1 AS (
  SELECT *,
    close / NULLIF(lag(close, 1) {w}, 0) - 1 AS ret,
    close / NULLIF(lag(close, 21) {w}, 0) - 1 AS chg21,
    close / NULLIF(lag(close, 5) {w}, 0) - 1 AS lag_ret_5,
    close / NULLIF(lag(close, 10) {w}, 0) - 1 AS lag_ret_10,
    max(close) {win(order, key, rows=63)} AS runmax63
  FROM {src}
),
p2 AS (
  SELECT *,
    {gated('avg', 'close', 50, key=key, order=order)} AS sma50_now,
    {gated('avg', 'close', 200, key=key, order=order)} AS sma200_now,
    {gated('stddev_samp', 'ret', 63, key=key, order=order)} AS std63,
    {gated('stddev_samp', 'ret', 252, key=key, order=order)} AS std252,
    {gated('avg', 'ret', 63, key=key, order=order)} AS mean63,
    {gated('avg', 'volume', 63, key=key, order=order)} AS avgv63,
    close / NULLIF(runmax63, 0) - 1 AS dd,
    {gated('skewness', 'ret', 63, key=key, order=order)} AS skew_3m,
    {gated('kurtosis', 'ret', 63, key=key, order=order)} AS kurt_3m
  FROM p1
),
p3 AS (
  SELECT *,
    ret AS lag_ret_1,
    lag(chg21, 1) {w} AS return_1m,
    lag(sma50_now, 1) {w} AS sma_50,
    lag(sma200_now, 1) {w} AS sma_200,
    lag(std63, 1) {w} AS volatility_3m,
    lag(std252, 1) {w} AS volatility_12m,
    lag(mean63, 1) {w} AS mean63_s,
    lag(avgv63, 1) {w} AS avg_volume_3m,
    min(dd) {win(order, key, rows=63)} AS mdd_now,
    lag(close, 1) {w} AS close_s
  FROM p2
),
price AS (
  SELECT *,
    lag(mdd_now, 1) {w} AS max_drawdown_3m,
    sma_50 / NULLIF(sma_200, 0) AS sma_ratio,
    mean63_s / (volatility_3m + 1e-6) AS sharpe_3m,
    avg_volume_3m / NULLIF(volatility_3m, 0) AS volume_volatility,
    close_s / NULLIF(sma_50, 0) AS price_vs_sma50,
    close_s / NULLIF(sma_200, 0) AS price_vs_sma200
  FROM p3
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def select_rounded(src: str, keys: list[str], cols: list[str], digits: int = R) -> str:
    parts = keys + [rnd(c, c, digits) for c in cols]
    return f"SELECT {', '.join(parts)} FROM {src}"


def price_query(cols: list[str]) -> str:
    return with_ctes(BARS, price_ctes()) + "\n" + select_rounded(
        "price", ["symbol", "date"], cols)


def label_ctes(src: str = "bars") -> str:
    return LABEL_CTES.replace("FROM bars", f"FROM {src}")


LABEL_CTES = """
fwd AS (
  SELECT *, lead(close, 63) OVER (PARTITION BY symbol ORDER BY date) / NULLIF(close, 0) - 1
            AS target_3m_raw
  FROM bars
),
thr AS (
  SELECT *, quantile_cont(target_3m_raw, 0.6) OVER (PARTITION BY symbol, year(date)) AS threshold
  FROM fwd
),
labelled AS (
  SELECT *, CAST(coalesce(target_3m_raw > threshold, false) AS INTEGER) AS target_3m FROM thr
)"""


def _seq(src: str = "bars") -> str:
    w = win()
    return f"""
seq AS (
  SELECT symbol, date, close, high, low, volume,
         row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn,
         greatest(coalesce(close - lag(close) {w}, 0), 0) AS gain,
         greatest(-coalesce(close - lag(close) {w}, 0), 0) AS loss
  FROM {src}
)"""


def rsi_sql(window: int = 21) -> str:
    r = f"(1 - 1.0::DOUBLE / {window})"   # com = window - 1  ->  alpha = 1 / window
    return "WITH RECURSIVE " + ",".join([BARS, _seq(), f"""
rec AS (
  SELECT symbol, rn, date, gain AS gn, loss AS ln, 1.0::DOUBLE AS den FROM seq WHERE rn = 1
  UNION ALL
  SELECT s.symbol, s.rn, s.date, s.gain + {r} * p.gn, s.loss + {r} * p.ln, 1 + {r} * p.den
  FROM rec p JOIN seq s ON s.symbol = p.symbol AND s.rn = p.rn + 1
),
raw AS (
  SELECT symbol, date, rn,
         CASE WHEN rn >= {window} THEN
           CASE WHEN gn / den + ln / den = 0 THEN NULL WHEN ln / den = 0 THEN 100.0::DOUBLE
                ELSE 100 - 100 / (1 + (gn / den) / (ln / den)) END END AS v
  FROM rec
)"""]) + f"""
SELECT symbol, date, {dr('lag(v) OVER (PARTITION BY symbol ORDER BY rn)')} AS rsi FROM raw"""


def macd_sql(short: int = 21, long: int = 50, signal: int = 15) -> str:
    a1, a2, a3 = (f"(1.0::DOUBLE / {short + 1})", f"(1.0::DOUBLE / {long + 1})",
                  f"(2.0::DOUBLE / {signal + 1})")
    return "WITH RECURSIVE " + ",".join([BARS, _seq(), f"""
rec AS (
  SELECT symbol, rn, date, close AS es, close AS el, 0.0::DOUBLE AS sig FROM seq WHERE rn = 1
  UNION ALL
  SELECT s.symbol, s.rn, s.date,
         {a1} * s.close + (1 - {a1}) * p.es,
         {a2} * s.close + (1 - {a2}) * p.el,
         {a3} * (({a1} * s.close + (1 - {a1}) * p.es) - ({a2} * s.close + (1 - {a2}) * p.el))
           + (1 - {a3}) * p.sig
  FROM rec p JOIN seq s ON s.symbol = p.symbol AND s.rn = p.rn + 1
)"""]) + f"""
SELECT symbol, date,
       {dr('lag(es - el) OVER (PARTITION BY symbol ORDER BY rn)')} AS macd,
       {dr('lag(sig) OVER (PARTITION BY symbol ORDER BY rn)')} AS macd_signal,
       {dr('lag(es - el - sig) OVER (PARTITION BY symbol ORDER BY rn)')} AS macd_indicator
FROM rec"""


def indicator_sqls() -> dict[str, str]:
    w = win()
    q = {"rsi": rsi_sql(), "macd": macd_sql()}
    q["bollinger"] = with_ctes(BARS, f"""
bb AS (
  SELECT symbol, date,
    {gated('avg', 'close', 20)} AS mid, {gated('stddev_samp', 'close', 20)} AS sd
  FROM bars
)""") + f"""
SELECT symbol, date, {dr(f'lag(mid + 2 * sd) {w}')} AS upper_bollinger,
       {dr(f'lag(mid - 2 * sd) {w}')} AS lower_bollinger FROM bb"""
    q["stochastic"] = with_ctes(BARS, f"""
k1 AS (
  SELECT symbol, date,
    (close - {gated('min', 'low', 21)})
      / NULLIF({gated('max', 'high', 21)} - {gated('min', 'low', 21)}, 0) * 100 AS k
  FROM bars
),
k2 AS (SELECT symbol, date, k, {gated('avg', 'k', 3)} AS d FROM k1)""") + f"""
SELECT symbol, date, {dr(f'lag(d) {w}')} AS stochastic_d, {dr(f'lag(k) {w}')} AS stochastic_k
FROM k2"""
    q["obv"] = with_ctes(BARS, f"""
o1 AS (
  SELECT symbol, date, volume,
    CASE WHEN close > lag(close) {w} THEN volume
         WHEN close < lag(close) {w} THEN -volume ELSE 0 END AS step
  FROM bars
),
o2 AS (SELECT symbol, date, sum(step) {win(frame='ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW')} AS run FROM o1)""") + f"""
SELECT symbol, date, {dr(f'lag(run) {w}')} AS obv FROM o2"""
    return q


def _nn(cols) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


VIXC = ["vix", "vix_change_20d", "vix_z20"]
CPIC = ["cpi", "cpi_yoy", "cpi_mom", "cpi_yoy_trend", "cpi_yoy_z"]
YLDC = ["yield_10y", "yield_10y_change", "yield_10y_roc", "yield_10y_z"]


def _z(x: str, k: int) -> str:
    return (f"({x} - {gated('avg', x, k, key=None)}) / "
            f"({gated('stddev_samp', x, k, key=None)} + 1e-9)")


MACRO_CTES = f"""
vs AS (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) / 10000.0::DOUBLE AS v
       FROM orders GROUP BY 1),
vix0 AS (
  SELECT date, v AS vix, v / NULLIF(lag(v, 20) OVER (ORDER BY date), 0) - 1 AS vix_change_20d,
         {_z('v', 20)} AS vix_z20
  FROM vs),
vixf AS (SELECT * FROM vix0 WHERE {_nn(VIXC)}),
ts AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_discount) * 1000.0::DOUBLE / 10.0::DOUBLE AS y
       FROM lineitem GROUP BY 1),
yld0 AS (
  SELECT date, y AS yield_10y, y - lag(y) OVER (ORDER BY date) AS yield_10y_change,
         y / NULLIF(lag(y) OVER (ORDER BY date), 0) - 1 AS yield_10y_roc,
         {_z('y', 60)} AS yield_10y_z
  FROM ts),
yldf AS (SELECT * FROM yld0 WHERE {_nn(YLDC)}),
cm AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
              avg(o_totalprice) / 1000.0::DOUBLE AS cpi FROM orders GROUP BY 1),
c1 AS (SELECT date, cpi, cpi / NULLIF(lag(cpi, 12) OVER (ORDER BY date), 0) - 1 AS cpi_yoy,
              cpi / NULLIF(lag(cpi, 1) OVER (ORDER BY date), 0) - 1 AS cpi_mom FROM cm),
c2 AS (SELECT *, {gated('avg', 'cpi_yoy', 6, key=None)} AS cpi_yoy_trend,
              {_z('cpi_yoy', 24)} AS cpi_yoy_z,
              lead(date) OVER (ORDER BY date) AS nxt FROM c1),
cd AS (SELECT CAST(unnest(generate_series(CAST(date AS TIMESTAMP),
                   CAST(coalesce(nxt - 1, date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day,
              cpi, cpi_yoy, cpi_mom, cpi_yoy_trend, cpi_yoy_z FROM c2),
cpif AS (SELECT day AS date, cpi, cpi_yoy, cpi_mom, cpi_yoy_trend, cpi_yoy_z FROM cd
         WHERE {_nn(CPIC)}),
cal0 AS (SELECT * FROM vixf FULL OUTER JOIN cpif USING (date) FULL OUTER JOIN yldf USING (date)),
macro AS (
  SELECT date, {", ".join(f"last_value({c} IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}" for c in VIXC + CPIC + YLDC)}
  FROM cal0)"""


def macro_sqls() -> dict[str, str]:
    q = {}
    for name, src, cols in (("vix_features", "vixf", VIXC), ("cpi_features", "cpif", CPIC),
                            ("yield_features", "yldf", YLDC), ("macro_calendar", "macro",
                                                               VIXC + CPIC + YLDC)):
        q[name] = with_ctes(MACRO_CTES) + "\n" + select_rounded(src, ["date"], cols)
    return q


SPLIT = "DATE '1999-01-01'"
SPLIT_CTES = f"""
sb AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, date <= {SPLIT} ORDER BY date DESC) AS rn_back
  FROM labelled
),
splitted AS (
  SELECT *, CASE WHEN date >= {SPLIT} THEN 'test'
                 WHEN date <= {SPLIT} AND rn_back > 1 THEN 'train' END AS split
  FROM sb
)"""


def _stoch_k(src: str) -> str:
    return f"""
sk AS (
  SELECT *, (close - {gated('min', 'low', 21)})
            / NULLIF({gated('max', 'high', 21)} - {gated('min', 'low', 21)}, 0) * 100 AS k_now
  FROM {src}
),
scored AS (
  SELECT symbol, date, target_3m AS label, p, split FROM (
    SELECT *, lag(k_now) {win()} / 100.0::DOUBLE AS p FROM sk)
  WHERE p IS NOT NULL AND split IS NOT NULL
)"""


GRID = """
grid AS (
  SELECT CAST(i AS INTEGER) AS t_idx,
         CASE WHEN i = 49 THEN 0.95::DOUBLE
              ELSE i * ((0.95::DOUBLE - 0.05::DOUBLE) / 49) + 0.05::DOUBLE END AS threshold
  FROM range(50) t(i)
),
sw AS (
  SELECT s.symbol, g.t_idx, g.threshold,
         CAST(sum(CASE WHEN s.label = 1 AND s.p >= g.threshold THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(sum(CASE WHEN s.label = 0 AND s.p >= g.threshold THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN s.label = 1 AND s.p < g.threshold THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM scored s CROSS JOIN grid g WHERE s.split = 'train'
  GROUP BY s.symbol, g.t_idx, g.threshold
),
sw2 AS (
  SELECT *, CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn)
                 ELSE 0.0::DOUBLE END AS f1
  FROM sw
),
sweep AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY f1 DESC, t_idx) = 1 AS is_best
  FROM sw2
),
pred AS (
  SELECT s.symbol, s.label, CAST(s.p >= coalesce(b.threshold, 0.5) AS INTEGER) AS pred, s.p
  FROM scored s LEFT JOIN (SELECT symbol, threshold FROM sweep WHERE is_best) b USING (symbol)
  WHERE s.split = 'test'
),
cnt AS (
  SELECT symbol,
    CAST(count(*) FILTER (WHERE label = 0 AND pred = 0) AS BIGINT) AS tn,
    CAST(count(*) FILTER (WHERE label = 0 AND pred = 1) AS BIGINT) AS fp,
    CAST(count(*) FILTER (WHERE label = 1 AND pred = 0) AS BIGINT) AS fn,
    CAST(count(*) FILTER (WHERE label = 1 AND pred = 1) AS BIGINT) AS tp
  FROM pred GROUP BY symbol
)"""


def _eval_base() -> str:
    return with_ctes(BARS, LABEL_CTES, SPLIT_CTES, _stoch_k("splitted"), GRID)


def _d0(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) > 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE 0.0::DOUBLE END"


def eval_sqls() -> dict[str, str]:
    q = {}
    w = win()
    q["forward_fill"] = with_ctes(BARS, f"""
j AS (SELECT b.symbol, b.date, x.close AS bench_close
      FROM bars b LEFT JOIN (SELECT date, close FROM bars WHERE symbol = 'AMERICA') x USING (date)),
f AS (SELECT *, last_value(bench_close IGNORE NULLS) {win(frame='ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW')} AS bench_close_ffill FROM j)""") + "\n" + select_rounded("f", ["symbol", "date"], ["bench_close", "bench_close_ffill"])
    q["relative_strength"] = with_ctes(BARS, f"""
j AS (SELECT b.symbol, b.date, b.close, a.close AS ca, e.close AS ce
      FROM bars b
      LEFT JOIN (SELECT date, close FROM bars WHERE symbol = 'AMERICA') a USING (date)
      LEFT JOIN (SELECT date, close FROM bars WHERE symbol = 'EUROPE') e USING (date)),
f AS (SELECT *, last_value(ca IGNORE NULLS) {win(frame='ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW')} AS fa,
              last_value(ce IGNORE NULLS) {win(frame='ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW')} AS fe FROM j),
g AS (SELECT symbol, date,
        (close / NULLIF(lag(close) {w}, 0) - 1) - (fa / NULLIF(lag(fa) {w}, 0) - 1) AS rs_america,
        (close / NULLIF(lag(close) {w}, 0) - 1) - (fe / NULLIF(lag(fe) {w}, 0) - 1) AS rs_europe
      FROM f)""") + "\n" + select_rounded("g", ["symbol", "date"], ["rs_america", "rs_europe"])
    base = with_ctes(BARS, LABEL_CTES, SPLIT_CTES)
    q["train_test_split"] = base + "\nSELECT symbol, date, split FROM splitted"
    q["walk_forward_folds"] = base + """,
tr AS (SELECT symbol, date, CAST(row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS BIGINT) AS row_idx,
              count(*) OVER (PARTITION BY symbol) AS n
       FROM splitted WHERE split = 'train')
SELECT symbol, date, row_idx,
       CAST(CASE WHEN n // 6 > 0 AND row_idx >= n - 5 * (n // 6)
                 THEN (row_idx - (n - 5 * (n // 6))) // (n // 6) ELSE -1 END AS INTEGER) AS test_fold
FROM tr"""
    q["recency_weights"] = base + f"""
SELECT symbol, date, {dr("pow(0.99::DOUBLE, CAST(date_diff('day', date, max(date) OVER (PARTITION BY symbol)) AS DOUBLE) / 30.0::DOUBLE)")} AS weight
FROM splitted WHERE split = 'train'"""
    q["class_balance"] = base + f"""
SELECT symbol, CAST(sum(target_3m) AS BIGINT) AS positives,
       CAST(count(*) - sum(target_3m) AS BIGINT) AS negatives,
       {dr('(count(*) - sum(target_3m)) / greatest(sum(target_3m), 1)')} AS pos_scale
FROM splitted WHERE split = 'train' GROUP BY symbol"""
    e = _eval_base()
    q["threshold_sweep"] = e + "\n" + select_rounded(
        "sweep", ["symbol", "t_idx"], ["threshold"]).replace(
        " FROM sweep", ", tp, fp, fn, " + rnd("f1") + ", is_best FROM sweep")
    q["confusion"] = e + """,
tot AS (SELECT symbol, tn, fp, fn, tp FROM cnt
        UNION ALL SELECT 'ALL', CAST(sum(tn) AS BIGINT), CAST(sum(fp) AS BIGINT),
                         CAST(sum(fn) AS BIGINT), CAST(sum(tp) AS BIGINT) FROM cnt)
SELECT symbol, 0 AS label, 0 AS pred, tn AS n FROM tot
UNION ALL SELECT symbol, 0, 1, fp FROM tot
UNION ALL SELECT symbol, 1, 0, fn FROM tot
UNION ALL SELECT symbol, 1, 1, tp FROM tot"""
    rep = f"""
rp AS (
  SELECT symbol, tn + fp AS s0, fn + tp AS s1, tn + fp + fn + tp AS n,
    {_d0('tn', 'tn + fn')} AS p0, {_d0('tn', 'tn + fp')} AS r0, {_d0('2 * tn', '2 * tn + fn + fp')} AS f0,
    {_d0('tp', 'tp + fp')} AS p1, {_d0('tp', 'tp + fn')} AS r1, {_d0('2 * tp', '2 * tp + fp + fn')} AS f1,
    {_d0('tn + tp', 'tn + fp + fn + tp')} AS acc
  FROM cnt
),
rows AS (
  SELECT symbol, '0' AS class_label, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM rp
  UNION ALL SELECT symbol, '1', p1, r1, f1, s1 FROM rp
  UNION ALL SELECT symbol, 'accuracy', NULL::DOUBLE, NULL::DOUBLE, acc, n FROM rp
  UNION ALL SELECT symbol, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM rp
  UNION ALL SELECT symbol, 'weighted avg', (p0 * s0 + p1 * s1) / NULLIF(n, 0),
                   (r0 * s0 + r1 * s1) / NULLIF(n, 0), (f0 * s0 + f1 * s1) / NULLIF(n, 0), n FROM rp
)"""
    q["classification_report"] = e + "," + rep + f"""
SELECT symbol, class_label, {rnd('precision')}, {rnd('recall')}, {rnd('f1')},
       CAST(support AS BIGINT) AS support FROM rows"""
    q["accuracy"] = e + f"""
SELECT p.symbol, {dr("avg(CASE WHEN label = pred THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)")} AS accuracy,
       count(*) AS n,
       {dr(_d0('2 * max(c.tp)', '2 * max(c.tp) + max(c.fp) + max(c.fn)'))} AS f1
FROM pred p JOIN cnt c USING (symbol) GROUP BY p.symbol"""
    q["roc_auc"] = with_ctes(BARS, LABEL_CTES, SPLIT_CTES, _stoch_k("splitted")) + f""",
rk AS (
  SELECT symbol, label,
         rank() OVER (PARTITION BY symbol ORDER BY p) + (count(*) OVER (PARTITION BY symbol, p) - 1) / 2.0::DOUBLE AS r
  FROM scored WHERE split = 'test'
),
agg AS (
  SELECT symbol, sum(CASE WHEN label = 1 THEN r ELSE 0 END) AS rs,
         CAST(sum(label) AS DOUBLE) AS np, CAST(count(*) - sum(label) AS DOUBLE) AS nn
  FROM rk GROUP BY symbol
)
SELECT symbol, {dr('(rs - np * (np + 1) / 2) / NULLIF(np * nn, 0)')} AS auc,
       CAST(np AS BIGINT) AS n_pos, CAST(nn AS BIGINT) AS n_neg FROM agg"""
    return q


def fundamentals_ctes() -> str:
    """CTEs ``fq .. fav``: statements derived from orders, parsed to long
    form, ratios, sparse filter, log gate, dedupe and alias resolution."""
    from ..sources.statements import ITEM_SPECS, TEXT_ITEMS
    aggs = ",\n    ".join(
        f"{dr(expr, 2, None)}"
        f" AS \"{st}__{item}\"" for st, item, expr in ITEM_SPECS)
    raw = "\n  UNION ALL ".join(
        [f"SELECT symbol, '{st}' AS statement, fiscal_date, '{item}' AS item, \"{st}__{item}\" AS value FROM fa"
         for st, item, _ in ITEM_SPECS]
        + [f"SELECT symbol, '{st}', fiscal_date, '{item}', NULL::DOUBLE FROM fa"
           for st, item, _ in TEXT_ITEMS])
    ctes = f"""
fq AS (
  SELECT r.r_name AS symbol,
         CAST(last_day(date_trunc('quarter', o.o_orderdate) + INTERVAL 2 MONTH) AS DATE) AS fiscal_date,
         o.o_totalprice AS p, o.o_orderstatus AS st, o.o_orderpriority AS pr, c.c_acctbal AS bal
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
),
fa AS (SELECT symbol, fiscal_date,
    {aggs}
  FROM fq GROUP BY symbol, fiscal_date),
raw AS (
  {raw}
),
rawf AS (SELECT * FROM raw),
pairs AS (SELECT * FROM (VALUES
    ('ProfitMargin', 'netIncome', 'totalRevenue'),
    ('DebtEquity', 'totalLiabilities', 'totalShareholderEquity'),
    ('CurrentRatio', 'totalCurrentAssets', 'totalCurrentLiabilities'),
    ('FreeCashFlowMargin', 'operatingCashflow', 'totalRevenue'),
    ('ROA', 'netIncome', 'totalAssets')) t(ratio, num, den)),
have AS (SELECT DISTINCT symbol, statement, item FROM rawf),
sdates AS (SELECT DISTINCT symbol, statement, fiscal_date FROM rawf),
rat AS (
  SELECT d.symbol, d.statement, d.fiscal_date, pr.ratio AS item, nv.value / NULLIF(dv.value, 0) AS value
  FROM sdates d
  JOIN pairs pr ON TRUE
  JOIN have h1 ON h1.symbol = d.symbol AND h1.statement = d.statement AND h1.item = pr.num
  JOIN have h2 ON h2.symbol = d.symbol AND h2.statement = d.statement AND h2.item = pr.den
  LEFT JOIN rawf nv ON nv.symbol = d.symbol AND nv.statement = d.statement
                   AND nv.fiscal_date = d.fiscal_date AND nv.item = pr.num
  LEFT JOIN rawf dv ON dv.symbol = d.symbol AND dv.statement = d.statement
                   AND dv.fiscal_date = d.fiscal_date AND dv.item = pr.den
),
allrows AS (SELECT * FROM rawf UNION ALL SELECT * FROM rat),
nd AS (SELECT symbol, statement, count(*) AS n FROM sdates GROUP BY symbol, statement),
nr AS (
  SELECT a.symbol, a.statement, a.item, CAST(nd.n - count(a.value) AS DOUBLE) / nd.n AS null_frac
  FROM allrows a JOIN nd ON nd.symbol = a.symbol AND nd.statement = a.statement
  GROUP BY a.symbol, a.statement, a.item, nd.n
),
kept AS (
  SELECT a.* FROM allrows a JOIN nr ON nr.symbol = a.symbol AND nr.statement = a.statement
                                  AND nr.item = a.item
  WHERE nr.null_frac <= 0.7
),
logged AS (
  SELECT symbol, statement, fiscal_date, item,
         CASE WHEN max(value) OVER (PARTITION BY symbol, statement, item) > 1e6 AND value > 0
              THEN ln(1 + value) ELSE value END AS value
  FROM kept
),
ranked AS (
  SELECT *, CASE statement WHEN 'income' THEN 0 WHEN 'balance' THEN 1 ELSE 2 END AS rk FROM logged
),
ded AS (
  SELECT symbol, statement, fiscal_date, item, value FROM (
    SELECT *, min(rk) OVER (PARTITION BY symbol, item) AS mrk FROM ranked) WHERE rk = mrk
),
alias AS (SELECT * FROM (VALUES
    ('total_liab', 'totalLiab', 0), ('total_liab', 'totalLiabilities', 1),
    ('equity', 'totalStockholderEquity', 0), ('equity', 'totalShareholderEquity', 1),
    ('current_assets', 'totalCurrentAssets', 0),
    ('current_liabilities', 'totalCurrentLiabilities', 0)) t(canonical, item, prio)),
fav AS (
  SELECT r.symbol, r.statement, r.fiscal_date, a.canonical, r.item AS source_item, r.value, a.prio,
         min(a.prio) OVER (PARTITION BY r.symbol, r.statement, a.canonical) AS best
  FROM rawf r JOIN alias a ON a.item = r.item
)"""
    return ctes


def fundamentals_sqls() -> dict[str, str]:
    ctes = fundamentals_ctes()
    q = {}
    q["statement_items"] = with_ctes(ctes) + "\n" + select_rounded(
        "rawf", ["symbol", "statement", "fiscal_date", "item"], ["value"])
    q["fundamental_ratios"] = with_ctes(ctes) + "\n" + select_rounded(
        "rat", ["symbol", "statement", "fiscal_date", "item"], ["value"])
    q["null_ratio_filter"] = with_ctes(ctes) + f"""
SELECT symbol, statement, item, {dr('null_frac')} AS null_frac, null_frac <= 0.7 AS kept FROM nr"""
    q["log_scale"] = with_ctes(ctes) + "\n" + select_rounded(
        "logged", ["symbol", "statement", "fiscal_date", "item"], ["value"])
    q["statement_dedup"] = with_ctes(ctes) + "\nSELECT DISTINCT symbol, item, statement FROM ded"
    q["first_available_alias"] = with_ctes(ctes) + f"""
SELECT symbol, statement, fiscal_date, canonical, source_item, {dr('value')} AS value
FROM fav WHERE prio = best"""
    from ..plans.catalog import ALL_ITEMS
    piv = ", ".join(f"{dr(f'max(CASE WHEN d.item = {chr(39)}{i}{chr(39)} THEN d.value END)')} AS \"{i}\""
                    for i in ALL_ITEMS)
    q["fundamentals_asof"] = with_ctes(BARS, ctes) + f""",
dates AS (SELECT DISTINCT symbol, fiscal_date FROM rawf),
iv AS (
  SELECT symbol, fiscal_date, fiscal_date + 90 AS eff_from,
         coalesce(lead(fiscal_date) OVER (PARTITION BY symbol ORDER BY fiscal_date) + 90,
                  fiscal_date + 91) AS eff_to
  FROM dates
),
fb AS (
  SELECT b.symbol, b.date, iv.fiscal_date
  FROM bars b LEFT JOIN iv ON iv.symbol = b.symbol AND b.date >= iv.eff_from AND b.date < iv.eff_to
  WHERE b.date >= coalesce((SELECT min(i2.eff_from) FROM iv i2 WHERE i2.symbol = b.symbol), b.date)
)
SELECT fb.symbol, fb.date, fb.fiscal_date, {piv}
FROM fb LEFT JOIN ded d ON d.symbol = fb.symbol AND d.fiscal_date = fb.fiscal_date
GROUP BY fb.symbol, fb.date, fb.fiscal_date"""
    wq = "OVER (PARTITION BY symbol ORDER BY fiscal_date)"
    q["quarterly_growth"] = with_ctes(ctes) + f""",
inc AS (
  SELECT symbol, fiscal_date, max(value) FILTER (WHERE item = 'totalRevenue') AS rev,
         max(value) FILTER (WHERE item = 'netIncome') AS ni
  FROM rawf WHERE statement = 'income' GROUP BY symbol, fiscal_date
),
inc2 AS (SELECT symbol, fiscal_date, ni / NULLIF(rev, 0) AS profit_margin,
                rev / NULLIF(lag(rev, 4) {wq}, 0) - 1 AS revenue_yoy FROM inc),
inc3 AS (SELECT *, profit_margin / NULLIF(lag(profit_margin, 4) {wq}, 0) - 1 AS profit_margin_yoy
         FROM inc2),
bd AS (SELECT DISTINCT symbol, fiscal_date FROM rawf WHERE statement = 'balance'),
bv AS (
  SELECT symbol, fiscal_date,
         max(value) FILTER (WHERE canonical = 'total_liab') AS tl,
         max(value) FILTER (WHERE canonical = 'equity') AS eq,
         max(value) FILTER (WHERE canonical = 'current_assets') AS ca,
         max(value) FILTER (WHERE canonical = 'current_liabilities') AS cl
  FROM fav WHERE prio = best AND statement = 'balance' GROUP BY symbol, fiscal_date
),
bal AS (
  SELECT bd.symbol, bd.fiscal_date, tl / NULLIF(eq, 0) AS debt_equity, ca / NULLIF(cl, 0) AS current_ratio
  FROM bd LEFT JOIN bv ON bv.symbol = bd.symbol AND bv.fiscal_date = bd.fiscal_date
),
bal2 AS (
  SELECT *, debt_equity / NULLIF(lag(debt_equity, 1) {wq}, 0) - 1 AS debt_equity_qoq,
            debt_equity / NULLIF(lag(debt_equity, 4) {wq}, 0) - 1 AS debt_equity_yoy,
            current_ratio / NULLIF(lag(current_ratio, 1) {wq}, 0) - 1 AS current_ratio_qoq
  FROM bal
),
g AS (SELECT * FROM inc3 FULL OUTER JOIN bal2 USING (symbol, fiscal_date))
""" + select_rounded("g", ["symbol", "fiscal_date"], [
        "profit_margin", "revenue_yoy", "profit_margin_yoy", "debt_equity", "current_ratio",
        "debt_equity_qoq", "debt_equity_yoy", "current_ratio_qoq"])
    return q


def technical_ctes(src: str) -> str:
    """CTEs ``tseq .. tech`` with the nine technical columns over ``src``."""
    w = win()
    wr = "OVER (PARTITION BY symbol ORDER BY rn)"
    r = "(1 - 1.0::DOUBLE / 21)"
    a1, a2, a3 = "(1.0::DOUBLE / 22)", "(1.0::DOUBLE / 51)", "(2.0::DOUBLE / 16)"
    return f"""
tseq AS (
  SELECT symbol, date, close, high, low, volume,
         row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn,
         greatest(coalesce(close - lag(close) {w}, 0), 0) AS gain,
         greatest(-coalesce(close - lag(close) {w}, 0), 0) AS loss,
         CASE WHEN close > lag(close) {w} THEN volume
              WHEN close < lag(close) {w} THEN -volume ELSE 0 END AS step
  FROM {src}
),
trec AS (
  SELECT symbol, rn, gain AS gn, loss AS ln, 1.0::DOUBLE AS den, close AS es, close AS el,
         0.0::DOUBLE AS sig FROM tseq WHERE rn = 1
  UNION ALL
  SELECT s.symbol, s.rn, s.gain + {r} * p.gn, s.loss + {r} * p.ln, 1 + {r} * p.den,
         {a1} * s.close + (1 - {a1}) * p.es, {a2} * s.close + (1 - {a2}) * p.el,
         {a3} * (({a1} * s.close + (1 - {a1}) * p.es) - ({a2} * s.close + (1 - {a2}) * p.el))
           + (1 - {a3}) * p.sig
  FROM trec p JOIN tseq s ON s.symbol = p.symbol AND s.rn = p.rn + 1
),
tw1 AS (
  SELECT *, {gated('avg', 'close', 20)} AS mid, {gated('stddev_samp', 'close', 20)} AS sd,
         (close - {gated('min', 'low', 21)})
           / NULLIF({gated('max', 'high', 21)} - {gated('min', 'low', 21)}, 0) * 100 AS k_now,
         sum(step) {win(frame='ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW')} AS run
  FROM tseq
),
tw2 AS (SELECT *, {gated('avg', 'k_now', 3)} AS d_now FROM tw1),
tj AS (SELECT t.*, c.gn, c.ln, c.den, c.es, c.el, c.sig FROM tw2 t JOIN trec c USING (symbol, rn)),
tech AS (
  SELECT symbol, date,
    lag(CASE WHEN rn >= 21 THEN
          CASE WHEN gn / den + ln / den = 0 THEN NULL WHEN ln / den = 0 THEN 100.0::DOUBLE
               ELSE 100 - 100 / (1 + (gn / den) / (ln / den)) END END) {wr} AS rsi,
    lag(es - el) {wr} AS macd, lag(sig) {wr} AS macd_signal, lag(es - el - sig) {wr} AS macd_indicator,
    lag(mid + 2 * sd) {wr} AS upper_bollinger, lag(mid - 2 * sd) {wr} AS lower_bollinger,
    lag(d_now) {wr} AS stochastic_d, lag(k_now) {wr} AS stochastic_k, lag(run) {wr} AS obv
  FROM tj
)"""


def rs_ctes(src: str) -> str:
    w = win()
    full = win(frame='ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW')
    return f"""
rsj AS (SELECT b.symbol, b.date, b.close, a.close AS ca, e.close AS ce
        FROM {src} b
        LEFT JOIN (SELECT date, close FROM bars WHERE symbol = 'AMERICA') a USING (date)
        LEFT JOIN (SELECT date, close FROM bars WHERE symbol = 'EUROPE') e USING (date)),
rsf AS (SELECT *, last_value(ca IGNORE NULLS) {full} AS fa, last_value(ce IGNORE NULLS) {full} AS fe
        FROM rsj),
rs AS (SELECT symbol, date,
        (close / NULLIF(lag(close) {w}, 0) - 1) - (fa / NULLIF(lag(fa) {w}, 0) - 1) AS rs_america,
        (close / NULLIF(lag(close) {w}, 0) - 1) - (fe / NULLIF(lag(fe) {w}, 0) - 1) AS rs_europe
      FROM rsf)"""


PRICE_OUT = ["return_1m", "sma_50", "sma_200", "sma_ratio", "volatility_3m", "volatility_12m",
             "sharpe_3m", "max_drawdown_3m", "avg_volume_3m", "volume_volatility", "lag_ret_1",
             "lag_ret_5", "lag_ret_10", "skew_3m", "kurt_3m", "price_vs_sma50", "price_vs_sma200"]
TECH_OUT = ["rsi", "macd", "macd_signal", "macd_indicator", "upper_bollinger", "lower_bollinger",
            "stochastic_d", "stochastic_k", "obv"]


def panel_body() -> tuple[str, list[str]]:
    """The CTEs up to ``final``, and its double columns."""
    from ..plans.catalog import ALL_ITEMS
    fund = fundamentals_ctes()
    piv = ", ".join(f"max(CASE WHEN d.item = '{i}' THEN d.value END) AS \"{i}\"" for i in ALL_ITEMS)
    base_cols = ["open", "high", "low", "close", "volume"] + PRICE_OUT + ["target_3m_raw"]
    body = ",".join([BARS, price_ctes(), label_ctes("price"), MACRO_CTES, fund, f"""
dates AS (SELECT DISTINCT symbol, fiscal_date FROM rawf),
iv AS (
  SELECT symbol, fiscal_date, fiscal_date + 90 AS eff_from,
         coalesce(lead(fiscal_date) OVER (PARTITION BY symbol ORDER BY fiscal_date) + 90,
                  fiscal_date + 91) AS eff_to
  FROM dates
),
trimmed AS (
  SELECT l.*, iv.fiscal_date AS fdate
  FROM labelled l LEFT JOIN iv ON iv.symbol = l.symbol AND l.date >= iv.eff_from AND l.date < iv.eff_to
  WHERE l.date >= coalesce((SELECT min(i2.eff_from) FROM iv i2 WHERE i2.symbol = l.symbol), l.date)
),
fund AS (
  SELECT t.symbol, t.date, {piv}
  FROM trimmed t LEFT JOIN ded d ON d.symbol = t.symbol AND d.fiscal_date = t.fdate
  GROUP BY t.symbol, t.date
)""", technical_ctes("trimmed"), rs_ctes("trimmed"), """
final AS (
  SELECT t.*, m.* EXCLUDE (date), f.* EXCLUDE (symbol, date), x.* EXCLUDE (symbol, date),
         r.* EXCLUDE (symbol, date)
  FROM trimmed t LEFT JOIN macro m ON m.date = t.date
  JOIN fund f ON f.symbol = t.symbol AND f.date = t.date
  JOIN tech x ON x.symbol = t.symbol AND x.date = t.date
  JOIN rs r ON r.symbol = t.symbol AND r.date = t.date
)"""])
    cols = base_cols + VIXC + CPIC + YLDC + list(ALL_ITEMS) + TECH_OUT + ["rs_america", "rs_europe"]
    return "WITH RECURSIVE " + body, cols


def panel_sql() -> str:
    body, cols = panel_body()
    sel = ", ".join(["symbol", "date", "target_3m"] + [f'{dr(chr(34) + c + chr(34))} AS "{c}"' for c in cols])
    return body + f"\nSELECT {sel} FROM final"


def model_sqls() -> dict[str, str]:
    """What surrounds the model, over all its inputs."""
    body, cols = panel_body()
    feats = [c for c in cols if c != "target_3m_raw"]
    train = f"""
sp AS (SELECT *, row_number() OVER (PARTITION BY symbol, date <= {SPLIT} ORDER BY date DESC) AS back FROM final),
tr AS (SELECT * FROM sp WHERE date <= {SPLIT} AND back > 1 AND date < {SPLIT})"""
    listed = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in feats)
    corr = body + "," + train + f""",
cast_tr AS (SELECT symbol, CAST(target_3m AS DOUBLE) AS y, {listed} FROM tr),
u AS (UNPIVOT cast_tr ON {", ".join(f'"{c}"' for c in feats)} INTO NAME feature VALUE value),
corr AS (SELECT symbol, feature, covar_pop(value, y) / NULLIF(stddev_pop(value) * stddev_pop(y), 0) AS corr
         FROM u WHERE value IS NOT NULL GROUP BY symbol, feature)"""
    flags = ", ".join(f'CAST("{c}" IS NULL AS INTEGER) AS "{c}_missing"' for c in feats)
    embargo = """,
lab AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS last_rows
        FROM tr WHERE target_3m_raw IS NOT NULL),
emb AS (SELECT * FROM lab WHERE last_rows > 63)"""
    frame = body + "," + train + embargo + f""",
wt AS (
  SELECT *, pow(0.99::DOUBLE, CAST(date_diff('day', date, max(date) OVER (PARTITION BY symbol)) AS DOUBLE) / 30.0::DOUBLE) AS rec,
         sum(target_3m) OVER (PARTITION BY symbol) AS pos, count(*) OVER (PARTITION BY symbol) AS n
  FROM emb
),
ww AS (SELECT *, CASE WHEN target_3m = 1 THEN rec * ((n - pos) / greatest(pos, 1)) ELSE rec END AS weight FROM wt)
SELECT symbol, date, CAST(target_3m AS DOUBLE) AS label, {rnd('weight')}, {flags} FROM ww"""
    tested = f"""
tested AS (SELECT symbol, count(*) AS n_test FROM final WHERE date >= {SPLIT} AND target_3m_raw IS NOT NULL GROUP BY symbol)"""
    # A fit has no SQL: its rows are counted here, and each symbol is to be learned.
    bounds = body + "," + train + embargo + "," + tested + """
SELECT symbol, count(*) AS n_train, true AS learned, any_value(n_test) AS n_test
FROM emb LEFT JOIN tested USING (symbol) GROUP BY symbol"""
    return {
        "feature_label_corr": corr + f"\nSELECT symbol, feature, {rnd('corr')} FROM corr",
        "mean_corr": corr + f"\nSELECT feature, {dr('avg(corr)')} AS mean_corr FROM corr GROUP BY feature",
        "training_frame": frame,
        "model_bounds": bounds,
        "symbol_models": bounds,
        "model_round_trip": body + "," + tested + "\nSELECT symbol, n_test, n_test AS n_scored, n_test AS n_same FROM tested",
    }


def gapped_sql() -> str:
    """Indicators over bars with gaps; fills and recurrences are spelled out."""
    full = win(frame='ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW')
    filled = ", ".join(f"last_value({c} IGNORE NULLS) {full} AS {c}" for c in ("high", "low", "close", "volume"))
    gapped = ", ".join(f"CASE WHEN day(date) % 7 <> 0 THEN {c} END AS {c}" for c in ("high", "low", "close", "volume"))
    r, r20 = "(1 - 1.0::DOUBLE / 22)", "(1 - 1.0::DOUBLE / 21)"
    return "WITH RECURSIVE " + ",".join([BARS, f"""
gb AS (SELECT symbol, date, {gapped} FROM bars),
gn AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn FROM gb),
ge AS (
  SELECT symbol, rn, date, close AS m, CASE WHEN close IS NULL THEN 0 ELSE 1 END::DOUBLE AS wt,
         coalesce(close, 0) AS num, CASE WHEN close IS NULL THEN 0 ELSE 1 END::DOUBLE AS den,
         CASE WHEN close IS NULL THEN 0 ELSE 1 END AS seen
  FROM gn WHERE rn = 1
  UNION ALL
  SELECT s.symbol, s.rn, s.date,
         CASE WHEN s.close IS NULL THEN p.m WHEN p.m IS NULL THEN s.close
              ELSE ({r} * p.wt * p.m + (1 - {r}) * s.close) / ({r} * p.wt + (1 - {r})) END,
         CASE WHEN s.close IS NULL THEN {r} * p.wt ELSE 1.0::DOUBLE END,
         coalesce(s.close, 0) + {r20} * p.num,
         CASE WHEN s.close IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END + {r20} * p.den,
         p.seen + CASE WHEN s.close IS NULL THEN 0 ELSE 1 END
  FROM ge p JOIN gn s ON s.symbol = p.symbol AND s.rn = p.rn + 1
),
filled AS (SELECT symbol, date, {filled} FROM gb)""", technical_ctes("filled")]) + f"""
SELECT x.symbol, x.date, {rnd('ge.m', 'ewm_plain')},
       {rnd('CASE WHEN ge.seen >= 21 THEN ge.num / NULLIF(ge.den, 0) END', 'ewm_adjusted')},
       {", ".join(rnd('x.' + c, c) for c in TECH_OUT)}
FROM tech x JOIN ge USING (symbol, date)"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    bar_cols = ["open", "high", "low", "close", "volume"]
    q["bars_daily"] = with_ctes(BARS) + "\n" + select_rounded("bars", ["symbol", "date"], bar_cols)
    q["bars_hourly"] = with_ctes(BARS_HOURLY) + "\n" + select_rounded(
        "hbars", ["symbol", "date"], bar_cols)
    q["hourly_price_features"] = with_ctes(BARS_HOURLY, price_ctes("hbars")) + "\n" + \
        select_rounded("price", ["symbol", "date"], PRICE_OUT)
    q["returns_lagged"] = price_query(["return_1m"])
    q["sma_ratio"] = price_query(["sma_50", "sma_200", "sma_ratio"])
    q["volatility"] = price_query(["volatility_3m", "volatility_12m"])
    q["sharpe"] = price_query(["sharpe_3m"])
    q["avg_volume"] = price_query(["avg_volume_3m", "volume_volatility"])
    q["lagged_returns"] = price_query(["lag_ret_1", "lag_ret_5", "lag_ret_10"])
    q["price_vs_sma"] = price_query(["price_vs_sma50", "price_vs_sma200"])
    q["max_drawdown"] = price_query(["max_drawdown_3m"])
    q["skew_kurt"] = price_query(["skew_3m", "kurt_3m"])
    q["forward_return"] = with_ctes(BARS, LABEL_CTES) + "\n" + select_rounded(
        "labelled", ["symbol", "date"], ["close", "target_3m_raw"])
    q["yearly_label"] = with_ctes(BARS, LABEL_CTES) + f"""
SELECT symbol, date, CAST(year(date) AS INTEGER) AS year, {dr('threshold')} AS threshold,
       target_3m FROM labelled"""
    q["label_distribution"] = with_ctes(BARS, LABEL_CTES) + f"""
SELECT symbol, count(*) AS n_samples,
       CAST(sum(CASE WHEN target_3m = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos,
       CAST(sum(CASE WHEN target_3m = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_neg,
       {dr('sum(target_3m) / count(*)')} AS ratio_pos,
       {dr('avg(CASE WHEN target_3m = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)')} AS share_neg,
       {dr('avg(CASE WHEN target_3m = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)')} AS share_pos,
       min(date) AS first_date, max(date) AS last_date
FROM labelled GROUP BY symbol"""
    q.update(indicator_sqls())
    q.update(macro_sqls())
    q.update(eval_sqls())
    q.update(fundamentals_sqls())
    q["feature_panel"] = panel_sql()
    q.update(model_sqls())
    q["gapped_indicators"] = gapped_sql()
    q["bars_filtered"] = (with_ctes(BARS) + "\n" + select_rounded("bars", ["symbol", "date"], bar_cols)
                          + " WHERE symbol IN ('ASIA', 'EUROPE') AND date BETWEEN DATE '1994-03-01' AND DATE '1997-02-28'")
    q["features_round_trip"] = price_query(["close", *PRICE_OUT])
    from . import oracle_long
    q.update(oracle_long.build())
    return q
