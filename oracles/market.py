"""Trades: metrics, alerts, dashboards and the streams over them."""

from .parts import big, count_if, mean, query, ratio, rnd

_BUY = "sum(CASE WHEN NOT maker THEN q ELSE 0 END)"
_SELL = "sum(CASE WHEN maker THEN q ELSE 0 END)"


def _dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _value(x: str) -> str:
    return f"(CAST({x} AS DOUBLE) / 100)"


_AVG = ratio("sum(p100)", "count(*) * 100", 4)
_METRICS = f"""count(*) AS trade_count, {_dbl('sum(q)')} AS total_volume, {_value('sum(v100)')} AS total_value,
  {ratio('sum(v100)', 'sum(q) * 100', 4)} AS vwap, {_AVG} AS avg_price, min(price) AS min_price, max(price) AS max_price,
  {rnd('(max(price) - min(price)) / (CAST(sum(p100) AS DOUBLE) / 100 / count(*)) * 100', 4)} AS price_range_pct,
  {_dbl(_BUY)} AS buy_volume, {_dbl(_SELL)} AS sell_volume,
  {rnd(f'{_dbl(_BUY)} / ({_dbl(_SELL)} + 0.0001)', 4)} AS buy_sell_ratio"""


def alerts(keys: str) -> str:
    return f"""alerted AS (
  SELECT *, abs(price_change_pct) > 0.1 AS moved, CASE WHEN price_change_pct > 0 THEN 'UP' ELSE 'DOWN' END AS dir FROM (
    SELECT *, {rnd('(current_price - previous_price) / previous_price * 100', 4)} AS price_change_pct FROM (
      SELECT {keys}, count(*) AS trade_count, arg_min(price, (ms, trade_id)) AS previous_price,
        arg_max(price, (ms, trade_id)) AS current_price, CAST(sum(q) AS DOUBLE) AS volume_in_window,
        make_timestamp(max(ms) * 1000) AS alert_time
      FROM trade GROUP BY ALL))),
alert_rows AS (
  SELECT * EXCLUDE (moved, dir), CASE WHEN moved THEN 'PRICE_' || dir ELSE 'VOLUME_SPIKE' END AS alert_type,
    CASE WHEN moved AND abs(price_change_pct) > 0.5 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
    CASE WHEN moved THEN symbol || ' price moved ' || dir || ' ' || format('{{:.2f}}', {rnd('abs(price_change_pct)', 2)})
        || '% ($' || format('{{:,.2f}}', previous_price) || ' → $' || format('{{:,.2f}}', current_price) || ')'
      ELSE symbol || ' volume spike: ' || trade_count || ' trades in batch' END AS message
  FROM alerted WHERE moved OR trade_count > 2)"""


_DAY = "CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS batch_id, symbol"

_SUMMARY = f"""SELECT symbol, {rnd('arg_max(price, (ms, trade_id))', 2)} AS current_price,
  {rnd('(arg_max(price, (ms, trade_id)) - arg_min(price, (ms, trade_id))) / arg_min(price, (ms, trade_id)) * 100', 2)}
    AS change_pct, count(*) AS total_trades, {_value('sum(v100)')} AS volume_value, min(price) AS session_low,
  max(price) AS session_high, {ratio(_BUY, _SELL, 2)} AS buy_sell_ratio FROM trade GROUP BY symbol"""

_LITE = f"""SELECT symbol, count(*) AS total_trades, {_value('sum(v100)')} AS total_volume_value, min(price) AS low,
  max(price) AS high, {ratio('sum(p100)', 'count(*) * 100', 2)} AS avg_price FROM trade GROUP BY symbol"""

_SESSION = f"""SELECT symbol, {big('sum(trade_count)')} AS total_trades,
  {_value('sum(CAST(round(total_value * 100) AS BIGINT))')} AS total_volume_value, {mean('vwap', 2, 4)} AS avg_vwap,
  min(min_price) AS session_low, max(max_price) AS session_high, {mean('buy_sell_ratio', 2, 4)} AS avg_buy_sell_ratio
FROM (SELECT {_DAY}, {_METRICS} FROM trade GROUP BY ALL) GROUP BY symbol"""


def _volume(unit: str) -> str:
    return f"""SELECT date_trunc('{unit}', make_timestamp(ms * 1000)) AS {unit}, symbol, count(*) AS trades,
  {_value('sum(v100)')} AS volume_value, {ratio('sum(p100)', 'count(*) * 100', 2)} AS avg_price FROM trade GROUP BY ALL"""


_LIVE = f"""SELECT date_trunc('second', make_timestamp(ms * 1000)) AS second, symbol, count(*) AS trades,
  {ratio('sum(p100)', 'count(*) * 100', 2)} AS price FROM trade
WHERE make_timestamp(ms * 1000) > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 1440 MINUTES GROUP BY ALL"""

_B, _S = (f"sum(CASE WHEN {m} THEN v100 ELSE 0 END)" for m in ("NOT maker", "maker"))
_PRESSURE = f"""SELECT symbol, count(*) AS total_trades, {count_if('NOT maker')} AS buy_trades,
  {count_if('maker')} AS sell_trades, {_value(_B)} AS buy_value, {_value(_S)} AS sell_value,
  {ratio(_B, _S, 2)} AS buy_sell_ratio FROM trade GROUP BY symbol"""

_RECENT = """SELECT make_timestamp(ms * 1000) AS trade_timestamp, symbol, trade_id, price, CAST(q AS DOUBLE) AS quantity,
  price * q AS trade_value, CASE WHEN maker THEN 'SELL' ELSE 'BUY' END AS trade_side
FROM trade ORDER BY ms DESC, trade_id DESC LIMIT 50"""

_LANDED = """SELECT 'trade' AS event_type, ms AS event_time, symbol, trade_id, price, CAST(q AS DOUBLE) AS quantity,
  trade_id * 2 AS buyer_order_id, trade_id * 2 + 1 AS seller_order_id, ms AS trade_time, maker AS is_buyer_maker,
  price * q AS trade_value"""

_WINDOWS = f"""SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
  symbol, {_METRICS} FROM trade
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR
  <= (SELECT make_timestamp(max(ms) * 1000) - INTERVAL 10 MINUTES FROM trade)
GROUP BY 1, 2, 3"""

_HELD = "trade_id % 9 = 0"
_FIRST_MARK = f"(SELECT max(ms) - 600000 FROM trade WHERE NOT ({_HELD}))"
_IS_LATE = f"({_HELD} AND ms // 60000 * 60000 + 60000 <= {_FIRST_MARK})"
_WIDTHS = " UNION ALL ".join(
    f"""SELECT CAST({w} AS INT) AS width, make_timestamp(ms // {w}000 * {w}000000) AS window_start,
  make_timestamp((ms // {w}000 + 1) * {w}000000) AS window_end, symbol, {_METRICS} FROM trade
WHERE NOT {_IS_LATE} AND (ms // {w}000 + 1) * {w}000 <= (SELECT max(ms) - 600000 FROM trade) GROUP BY 1, 2, 3, 4"""
    for w in (60, 300)
)

SQL = {
    "stream_once": query(_LANDED + ", CAST(CASE WHEN trade_id % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS batch_id FROM trade", "trade"),
    "stream_widths": query(_WIDTHS, "trade"),
    "stream_late": query(
        f"SELECT trade_id, symbol, ms AS trade_time, price, CAST(q AS DOUBLE) AS quantity FROM trade WHERE {_IS_LATE}", "trade"
    ),
    "stream_totals": query(
        """SELECT 'batches' AS name, count(DISTINCT trade_id % 2) AS total FROM trade
        UNION ALL SELECT 'trades', count(*) FROM trade UNION ALL SELECT 'alerts', count(*) FROM alert_rows""",
        "trade", extra=alerts("trade_id % 2 AS wave, symbol"),
    ),
    "stream_batches": query(
        "SELECT symbol, count(*) AS trades, CAST(sum(trade_id) AS BIGINT) AS id_sum, true AS several_batches "
        "FROM trade GROUP BY symbol",
        "trade",
    ),
    "trade_rejects": """SELECT CASE WHEN event_id % 23 = 0 THEN 'not JSON' WHEN event_id % 17 = 0 THEN 'unreadable price'
          ELSE 'unreadable quantity' END AS reason, count(*) AS messages
        FROM events WHERE event_id % 23 = 0 OR (event_id % 7 <> 0 AND (event_id % 17 = 0 OR event_id % 19 = 0)) GROUP BY 1""",
    "trade_normalise": query(_LANDED + " FROM trade WHERE trade_id % 7 <> 0", "trade"),
    "trade_metrics": query(f"SELECT symbol, {_METRICS} FROM trade GROUP BY symbol", "trade"),
    "trade_alerts": query("SELECT * FROM alert_rows", "trade", extra=alerts("symbol")),
    "market_summary": query(_SUMMARY, "trade"),
    "market_lite": query(_LITE, "trade"),
    "session_rollup": query(_SESSION, "trade"),
    "volume_per_minute": query(_volume("minute"), "trade"),
    "volume_per_second": query(_volume("second"), "trade"),
    "live_activity": query(_LIVE, "trade"),
    "pressure": query(_PRESSURE, "trade"),
    "recent_trades": query(_RECENT, "trade"),
    "recent_alerts": query(
        """SELECT alert_time, symbol, alert_type, severity, message, price_change_pct FROM alert_rows
        ORDER BY alert_time DESC, symbol LIMIT 20""",
        "trade", extra=alerts(_DAY),
    ),
    "latest_trade": query(
        """SELECT symbol, trade_id, price, CAST(q AS DOUBLE) AS quantity FROM trade
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ms DESC, trade_id DESC) = 1""",
        "trade",
    ),
    "stream_raw": query(_LANDED + ", make_timestamp(ms * 1000) AS trade_timestamp FROM trade", "trade"),
    "stream_metrics": query(f"SELECT symbol, {_METRICS} FROM trade GROUP BY symbol", "trade"),
    "stream_alerts": query("SELECT * EXCLUDE (alert_time) FROM alert_rows", "trade", extra=alerts("symbol")),
    "stream_windowed": query(_WINDOWS, "trade"),
    "stream_dedup": query(_LANDED + " FROM trade", "trade"),
    "stream_normalise": query(_LANDED + " FROM trade WHERE trade_id % 7 <> 0", "trade"),
    "ndjson_roundtrip": query(_LANDED + ", ms AS ingestion_time, 'bindings' AS producer_id FROM trade", "trade"),
}
