"""Files whose schema is found on the way, and input that does not fit."""

from .parts import query

_WAVES = """SELECT trade_id, symbol, ms AS trade_time, CAST(q AS DOUBLE) AS quantity,
  CASE WHEN trade_id % 2 = 0 THEN floor(price) ELSE price END AS price,
  CASE WHEN trade_id % 2 = 0 THEN '' ELSE 'n' END || trade_id AS note,
  CASE WHEN trade_id % 2 = 1 THEN maker END AS is_buyer_maker FROM trade"""

_VERSIONS = """SELECT version, field, type, count(*) AS values FROM trade
JOIN (VALUES (CAST(1 AS BIGINT), 0, 'trade_id', 'bigint'), (1, 0, 'symbol', 'string'), (1, 0, 'trade_time', 'bigint'),
  (1, 0, 'quantity', 'double'), (1, 0, 'price', 'bigint'), (1, 0, 'note', 'bigint'),
  (2, 1, 'trade_id', 'bigint'), (2, 1, 'symbol', 'string'), (2, 1, 'trade_time', 'bigint'), (2, 1, 'quantity', 'double'),
  (2, 1, 'price', 'double'), (2, 1, 'note', 'string'), (2, 1, 'is_buyer_maker', 'boolean')) AS f(version, odd, field, type)
ON trade_id % 2 = odd GROUP BY 1, 2, 3"""

_RESCUED = """SELECT CASE WHEN NOT cut THEN trade_id END AS trade_id, CASE WHEN NOT cut AND trade_id % 7 <> 0 THEN price END AS price,
  CASE WHEN NOT cut AND trade_id % 11 <> 0 THEN q END AS quantity, CASE WHEN NOT cut THEN symbol END AS symbol,
  CASE WHEN NOT cut THEN ms END AS trade_time,
  CASE WHEN NOT cut AND len(rest) > 0 THEN '{' || array_to_string(rest, ',') || '}' END AS rescued,
  CASE WHEN cut THEN '{"trade_id":' || trade_id END AS corrupt
FROM (SELECT *, trade_id % 40 = 0 AS cut, list_filter([
    CASE WHEN trade_id % 7 = 0 THEN '"price":"none"' END,
    CASE WHEN trade_id % 11 = 0 THEN '"quantity":' || q || '.5' END,
    CASE WHEN trade_id % 3 = 0 THEN '"route":[' || trade_id || ',' || (trade_id + 1) || ']' END,
    CASE WHEN trade_id % 5 = 0 THEN '"seen.desk":"floor"' END], lambda x: x IS NOT NULL) AS rest FROM trade)"""

SQL = {
    "schema_waves": query(_WAVES, "trade"),
    "schema_versions": query(_VERSIONS, "trade"),
    "rescued_fields": query(_RESCUED, "trade"),
}
