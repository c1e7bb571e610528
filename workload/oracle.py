"""The same queries as SQL over the given tables (DuckDB dialect).

Written from the definition of each operator and not from its Spark expression:
joins where Spark uses frames, ranks where it uses aggregates, and so on.
"""

from __future__ import annotations

from workload.adapters import PAGE
from workload.queries import HALF_WAY_MS

TICK = "timestamp, crypto_id, price, volume, market_cap"
KEYED = "PARTITION BY crypto_id, timestamp"
SURVIVOR = "price DESC NULLS LAST, volume DESC NULLS LAST, market_cap DESC NULLS LAST"


def _round(x: str, digits: int) -> str:
    """Half up on the shortest decimal text of a double, which is what Spark rounds."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 17)), {digits}) AS DOUBLE)"


EVENTS = """ev AS (
  SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS uid, epoch_us(ts) // 1000 AS ms,
         round(value * 100) AS cents, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         round(value * 100) + event_id % 7 + 1 AS size, round(value * 100) * 3 + event_id % 11 AS cap
  FROM events)"""

BY_TYPE = f"""{EVENTS}, ticks AS (
  SELECT ms AS timestamp, event_type AS crypto_id, cents AS price, size AS volume,
         cap AS market_cap FROM ev)"""

BY_USER = f"""{EVENTS}, ticks AS (
  SELECT ms AS timestamp, uid AS crypto_id, cents AS price, size AS volume,
         cap AS market_cap FROM ev)"""

BY_PART = """ticks AS (
  SELECT epoch_us(l_shipdate) // 1000 AS timestamp, CAST(l_partkey AS VARCHAR) AS crypto_id,
         round(l_extendedprice * 100) AS price, l_quantity AS volume,
         round(l_extendedprice * 100) AS market_cap, l_returnflag FROM lineitem)"""

DIRTY = f"""{EVENTS}, base AS (
  SELECT CASE WHEN k BETWEEN 3 AND 5 THEN NULL WHEN k IN (18, 19) THEN ms * 1000000 ELSE ms END AS timestamp,
         CASE WHEN k < 3 THEN NULL ELSE uid END AS crypto_id,
         CASE WHEN k BETWEEN 6 AND 8 THEN NULL
              WHEN k BETWEEN 9 AND 11 THEN CAST('NaN' AS DOUBLE)
              WHEN k BETWEEN 12 AND 14 THEN -cents
              WHEN k BETWEEN 15 AND 17 THEN 0.0 ELSE cents END AS price,
         CASE WHEN k BETWEEN 20 AND 39 THEN NULL ELSE size END AS volume,
         cap AS market_cap, k FROM ev),
ticks AS (
  SELECT {TICK} FROM base
  UNION ALL SELECT timestamp, crypto_id, price, NULL, market_cap FROM base WHERE k BETWEEN 50 AND 59
  UNION ALL SELECT {TICK} FROM base WHERE k BETWEEN 60 AND 69
  UNION ALL SELECT timestamp, crypto_id, price, volume + 1, market_cap FROM base WHERE k BETWEEN 70 AND 79
  UNION ALL SELECT timestamp, crypto_id, -1.0, volume, market_cap FROM base WHERE k BETWEEN 80 AND 89
  UNION ALL SELECT timestamp, crypto_id, price + 1, NULL, market_cap FROM base WHERE k >= 90)"""

COMPLETE = ("crypto_id IS NOT NULL AND timestamp IS NOT NULL AND price IS NOT NULL "
            "AND NOT isnan(price)")

DATED = "timestamp >= -62135596800000 AND timestamp <= 253402300799999"

CLEAN = f"""clean AS (
  SELECT {TICK} FROM ticks WHERE {COMPLETE} AND {DATED} AND price > 0
  QUALIFY row_number() OVER ({KEYED} ORDER BY {SURVIVOR}) = 1)"""

DAY = "CAST(make_timestamp(timestamp * 1000) AS DATE)"

BARS = f"""ranked AS (
  SELECT *, {DAY} AS date,
         row_number() OVER (PARTITION BY crypto_id, {DAY} ORDER BY timestamp) AS up,
         row_number() OVER (PARTITION BY crypto_id, {DAY} ORDER BY timestamp DESC) AS down
  FROM clean),
bars AS (
  SELECT crypto_id, date,
         max(CASE WHEN up = 1 THEN price END) AS open, max(price) AS high, min(price) AS low,
         max(CASE WHEN down = 1 THEN price END) AS close,
         sum(volume) AS volume, {_round("sum(market_cap) / count(market_cap)", 0)} AS market_cap,
         CAST(count(*) AS BIGINT) AS data_points
  FROM ranked GROUP BY crypto_id, date)"""

# Sums of fractions, in decimals of ten places.
EXACT = "CAST(CAST(CAST({0} AS VARCHAR) AS DECIMAL(38, 17)) AS DECIMAL(38, 10))"
EXACT_BARS = BARS.replace("sum(volume)", f"CAST(sum({EXACT.format('volume')}) AS DOUBLE)").replace(
    "sum(market_cap)", f"CAST(sum({EXACT.format('market_cap')}) AS DOUBLE)")
FRACTIONAL = """ticks AS (
  SELECT epoch_us(l_shipdate) // 1000 AS timestamp, CAST(l_suppkey AS VARCHAR) AS crypto_id,
         round(l_extendedprice * 100) AS price, l_quantity + l_discount / 3 AS volume,
         l_extendedprice * (1 + l_tax) AS market_cap FROM lineitem)"""
# The end of the day of the latest ingest, 2024-01-31.
UNTIL_MS = 1706745599999

# Counting bars.
MA = ", ".join(
    _round(f"sum(close) OVER w{n} / count(*) OVER w{n}", 2) + f" AS ma_{n}d" for n in (7, 30))
VOLATILITY = _round("stddev_samp(close) OVER w7", 2) + " AS volatility_7d"
BY_BARS = "PARTITION BY crypto_id ORDER BY date"
ROWS = (f"WINDOW w AS ({BY_BARS}), w7 AS ({BY_BARS} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), "
        f"w30 AS ({BY_BARS} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)")


def _change(before: str, name: str) -> str:
    return _round(f"(close - {before}) / nullif({before}, 0) * 100", 2) + f" AS {name}"


LAGS = "lag(close, 1) OVER w AS prev_close, lag(close, 7) OVER w AS close_7d_ago"
CHANGES = f"{_change('prev_close', 'change_1d_pct')}, {_change('close_7d_ago', 'change_7d_pct')}"
BAR = "crypto_id, date, open, high, low, close, volume, market_cap, data_points"

# Counting days: the bars of the window are joined by date.
ON_DAYS = """calendar AS (
  SELECT b.crypto_id, b.date, any_value(b.close) AS close,
         sum(p.close) FILTER (p.date > b.date - 7) / count(p.close) FILTER (p.date > b.date - 7) AS m7,
         sum(p.close) / count(p.close) AS m30,
         max(p.close) FILTER (p.date = b.date - 1) AS prev_close,
         max(p.close) FILTER (p.date = b.date - 7) AS close_7d_ago,
         stddev_samp(p.close) FILTER (p.date > b.date - 7) AS s7
  FROM bars b JOIN bars p ON p.crypto_id = b.crypto_id
                          AND p.date > b.date - 30 AND p.date <= b.date
  GROUP BY b.crypto_id, b.date)"""
CAL_MA = f"{_round('m7', 2)} AS ma_7d, {_round('m30', 2)} AS ma_30d"
CAL_VOLATILITY = f"{_round('s7', 2)} AS volatility_7d"


def _metrics(ticks: str, bars: str = BARS) -> str:
    return f"""WITH {ticks}, {CLEAN}, {bars}, metrics AS (
      SELECT {BAR}, {MA}, {LAGS}, {VOLATILITY} FROM bars {ROWS})
    SELECT {BAR}, ma_7d, ma_30d, {CHANGES}, volatility_7d FROM metrics"""


DOCS = f"""{EVENTS}, paged AS (
  SELECT uid, event_id, ms, cents,
         row_number() OVER page_order AS i, count(*) OVER page AS n, first_value(k) OVER page_start AS k
  FROM ev
  WINDOW page AS (PARTITION BY uid, event_id // {PAGE}),
         page_order AS (PARTITION BY uid, event_id // {PAGE} ORDER BY ms, event_id),
         page_start AS (PARTITION BY uid, event_id // {PAGE} ORDER BY event_id)),
docs AS (
  SELECT *, CASE WHEN k BETWEEN 3 AND 4 THEN 'prices are null' WHEN k BETWEEN 5 AND 9 THEN 'price is not a pair'
                 WHEN k BETWEEN 10 AND 14 THEN 'no instant'
                 WHEN k BETWEEN 15 AND 19 AND n > 2 THEN 'volume is not a pair' END AS reason
  FROM paged)"""

EXPLODED = f"""{DOCS}, exploded AS (
  SELECT ms AS timestamp, uid AS crypto_id, cents AS price,
         CASE WHEN i <= n - 2 THEN cents END AS volume, cents AS market_cap
  FROM docs WHERE k >= 5 AND reason IS NULL)"""

REJECTED = f"""WITH {DOCS}
  SELECT uid AS id, reason, CAST(count(*) AS BIGINT) AS documents
  FROM docs WHERE i = 1 AND reason IS NOT NULL GROUP BY ALL"""

LISTING = """listing AS (
  SELECT uid AS id, 'u' || uid AS symbol, arg_max(cents, event_id) AS current_price,
         sum(cents) AS market_cap
  FROM ev GROUP BY uid)"""


def _top(k: int) -> str:
    return f"{LISTING}, top AS (SELECT * FROM listing ORDER BY market_cap DESC, id LIMIT {k})"


CONTRACT = f"""{EVENTS}, ticks AS (
  SELECT CASE WHEN k < 3 THEN NULL ELSE ms END AS timestamp,
         CASE WHEN k BETWEEN 6 AND 8 THEN NULL WHEN k BETWEEN 9 AND 11 THEN lpad(uid, 51, '0')
              WHEN k BETWEEN 12 AND 14 THEN lpad(uid, 50, '0') ELSE uid END AS crypto_id,
         cents AS price, size AS volume, cap AS market_cap,
         CASE WHEN k < 3 THEN 'timestamp is null' WHEN k < 6 THEN 'datetime is null'
              WHEN k < 9 THEN 'crypto_id is null' WHEN k < 12 THEN 'crypto_id is too long' END AS reason
  FROM ev)"""

SKIPPED = f"""WITH {BY_PART}, earlier AS (
    SELECT {TICK} FROM ticks WHERE l_returnflag = 'R'
    QUALIFY row_number() OVER ({KEYED} ORDER BY {SURVIVOR}) = 1),
  later AS (
    SELECT {TICK} FROM ticks t
    WHERE NOT EXISTS (SELECT 1 FROM earlier e
                      WHERE e.crypto_id = t.crypto_id AND e.timestamp = t.timestamp)
    QUALIFY row_number() OVER ({KEYED} ORDER BY {SURVIVOR}) = 1)
  SELECT * FROM earlier UNION ALL SELECT * FROM later"""

_DIRTY_METRICS = _metrics(DIRTY)
_USER_BARS = f"{BY_USER}, {CLEAN}, {BARS}"
_EXPLODED = f"WITH {EXPLODED} SELECT * FROM exploded"
_BY_TYPE = f"WITH {BY_TYPE} SELECT {TICK} FROM ticks"
_BY_USER = f"WITH {BY_USER} SELECT {TICK} FROM ticks"

ORACLE: dict[str, str] = {
    "drop_incomplete": f"WITH {DIRTY} SELECT {TICK} FROM ticks WHERE {COMPLETE}",
    "positive_price": f"""WITH {DIRTY} SELECT {TICK} FROM ticks
        WHERE price IS NOT NULL AND NOT isnan(price) AND price > 0""",
    "dedup_ticks": f"""WITH {DIRTY} SELECT {TICK} FROM ticks WHERE {COMPLETE}
        QUALIFY row_number() OVER ({KEYED} ORDER BY {SURVIVOR}) = 1""",
    "clean_ticks": f"WITH {DIRTY}, {CLEAN} SELECT {TICK} FROM clean",
    "clean_ticks_by_part": f"WITH {BY_PART}, {CLEAN} SELECT {TICK} FROM clean",
    "cleaning_report": f"""WITH {DIRTY}, {CLEAN}, counted AS (
        SELECT (SELECT count(*) FROM ticks) AS a,
               (SELECT count(*) FROM ticks WHERE {COMPLETE}) AS c,
               (SELECT count(*) FROM ticks WHERE {COMPLETE} AND {DATED}) AS d,
               (SELECT count(*) FROM ticks WHERE {COMPLETE} AND {DATED} AND price > 0) AS v,
               (SELECT count(*) FROM clean) AS f)
        SELECT a AS initial_rows, a - c AS incomplete_rows, c - d AS out_of_range_rows,
               d - v AS non_positive_rows,
               v - f AS duplicate_rows, f AS final_rows, a - f AS removed_rows FROM counted""",
    "tick_calendar": """SELECT epoch_us(ts) // 1000 AS timestamp, CAST(user_id AS VARCHAR) AS crypto_id,
        date_trunc('millisecond', ts) AS datetime, CAST(ts AS DATE) AS date FROM events""",
    "daily_ohlc": f"""WITH {BY_TYPE}, clean AS (SELECT * FROM ticks), {BARS}
        SELECT crypto_id, date, open, high, low, close, data_points FROM bars""",
    "daily_volume_cap": f"""WITH {DIRTY}, {CLEAN}, {BARS}
        SELECT crypto_id, date, volume, market_cap, data_points FROM bars""",
    "daily_bars": f"WITH {DIRTY}, {CLEAN}, {BARS} SELECT {BAR} FROM bars",
    "bar_counts": f"""WITH {BY_PART}, {CLEAN}, {BARS}
        SELECT count(*) AS bars, (SELECT count(*) FROM clean) AS ticks FROM bars""",
    "moving_averages": f"WITH {_USER_BARS} SELECT crypto_id, date, close, {MA} FROM bars {ROWS}",
    "lagged_closes": f"WITH {_USER_BARS} SELECT crypto_id, date, close, {LAGS} FROM bars {ROWS}",
    "price_changes": f"""WITH {_USER_BARS}, lagged AS (SELECT *, {LAGS} FROM bars {ROWS})
        SELECT crypto_id, date, close, {CHANGES} FROM lagged""",
    "volatility": f"""WITH {_USER_BARS}
        SELECT crypto_id, date, close, {VOLATILITY} FROM bars {ROWS}""",
    "calendar_moving_averages": f"""WITH {_USER_BARS}, {ON_DAYS}
        SELECT crypto_id, date, close, {CAL_MA} FROM calendar""",
    "calendar_price_changes": f"""WITH {_USER_BARS}, {ON_DAYS}
        SELECT crypto_id, date, close, {CHANGES} FROM calendar""",
    "calendar_volatility": f"""WITH {_USER_BARS}, {ON_DAYS}
        SELECT crypto_id, date, close, {CAL_VOLATILITY} FROM calendar""",
    "daily_metrics": _DIRTY_METRICS,
    "daily_metrics_by_user": _metrics(BY_USER),
    "daily_metrics_by_user_in_place": _metrics(BY_USER),
    "daily_metrics_by_type": _metrics(BY_TYPE),
    "daily_metrics_by_part": _metrics(BY_PART),
    "calendar_metrics_by_part": f"""WITH {BY_PART}, {CLEAN}, {BARS}, {ON_DAYS}
        SELECT b.crypto_id, b.date, b.open, b.high, b.low, b.close, b.volume, b.market_cap,
               b.data_points, c.* EXCLUDE (crypto_id, date)
        FROM bars b JOIN (
            SELECT crypto_id, date, {CAL_MA}, {CHANGES}, {CAL_VOLATILITY} FROM calendar) c
        ON c.crypto_id = b.crypto_id AND c.date = b.date""",
    "daily_metrics_unique_keys": _metrics(BY_USER),
    "daily_metrics_in_place": _DIRTY_METRICS,
    "daily_metrics_by_part_in_place": _metrics(BY_PART),
    "daily_metrics_sliced": _DIRTY_METRICS,
    "daily_metrics_by_part_sliced": _metrics(BY_PART),
    "densest_bar": f"""WITH {DIRTY}, counted AS (
        SELECT count(*) AS n FROM ticks WHERE {DATED} GROUP BY crypto_id, {DAY})
        SELECT max(n) AS rows FROM counted""",
    "metrics_preview": f"""SELECT crypto_id, date, close, ma_7d, change_1d_pct, volatility_7d
        FROM ({_metrics(BY_USER)}) ORDER BY crypto_id, date LIMIT 15""",
    "daily_bars_fractional": f"WITH {FRACTIONAL}, {CLEAN}, {EXACT_BARS} SELECT {BAR} FROM bars",
    "daily_metrics_fractional": _metrics(FRACTIONAL, EXACT_BARS),
    "raw_preview": f"""WITH {BY_PART} SELECT {TICK} FROM ticks
        ORDER BY crypto_id, timestamp, price, volume, market_cap LIMIT 5""",
    "top_k_messy_listing": f"""WITH {EVENTS}, {LISTING}, capped AS (
          SELECT id, symbol, current_price,
                 CASE WHEN CAST(id AS INT) % 7 IN (1, 2) THEN NULL ELSE market_cap END AS market_cap
          FROM listing)
        SELECT * FROM capped ORDER BY market_cap DESC NULLS LAST, id LIMIT 20""",
    "lookback_until": f"""WITH {BY_USER} SELECT {TICK} FROM ticks
        WHERE timestamp > {HALF_WAY_MS} - 7 * CAST(86400000 AS BIGINT) AND timestamp <= {HALF_WAY_MS}""",
    "latest_finished_snapshot": f"{_BY_USER} WHERE timestamp < {HALF_WAY_MS}",
    "snapshot_after_failed_rerun": _BY_USER,
    "bars_after_failed_rerun": f"WITH {_USER_BARS} SELECT {BAR} FROM bars",
    "load_nothing": f"{_BY_USER} WHERE FALSE",
    "ingest_counts": f"""WITH {EXPLODED}, {_top(5)}, chosen AS (
            SELECT * FROM exploded WHERE crypto_id IN (SELECT id FROM top)),
          counted AS (SELECT count(*) AS n, count(*) FILTER (timestamp > {UNTIL_MS} - 7 * CAST(86400000 AS BIGINT)
                      AND timestamp <= {UNTIL_MS}) AS w, count(*) FILTER (timestamp > {UNTIL_MS}) AS l FROM chosen)
        SELECT w AS ticks, (SELECT count(*) FROM docs WHERE i = 1 AND reason IS NOT NULL
                            AND uid IN (SELECT id FROM top)) AS documents_rejected,
               l AS ticks_refused, n - w - l AS ticks_before, n AS ticks_read FROM counted""",
    "explode_history": _EXPLODED,
    "explode_long_history": _EXPLODED,
    "history_points": f"""WITH {DOCS}
        SELECT uid AS id, CAST(sum(CASE WHEN k >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS points
        FROM docs GROUP BY uid""",
    "history_rejects": REJECTED,
    "history_json": _EXPLODED,
    "history_json_rejects": REJECTED,
    "top_k_series": f"WITH {EVENTS}, {_top(20)} SELECT * FROM top",
    "top_k_ids_small_profile": f"WITH {EVENTS}, {_top(5)} SELECT id FROM top",
    "listing_json": f"WITH {EVENTS}, {LISTING} SELECT * FROM listing",
    "restrict_to_top_k": f"""WITH {BY_USER}, {_top(20)}
        SELECT {TICK} FROM ticks WHERE crypto_id IN (SELECT id FROM top)""",
    "lookback": f"""WITH {BY_USER} SELECT {TICK} FROM ticks
        WHERE timestamp > (SELECT max(timestamp) FROM ticks) - 7 * CAST(86400000 AS BIGINT)""",
    "lookback_full_profile": f"""WITH {BY_PART} SELECT {TICK} FROM ticks
        WHERE timestamp > (SELECT max(timestamp) FROM ticks) - 365 * CAST(86400000 AS BIGINT)""",
    "union_ticks": f"""WITH {EVENTS}
        SELECT ms AS timestamp, uid AS crypto_id, cents AS price, size AS volume,
               cap AS market_cap FROM ev
        UNION ALL SELECT ms, event_type, cents, size, NULL FROM ev""",
    "latest_snapshot": """SELECT epoch_us(ts) // 1000 AS timestamp,
        date_trunc('millisecond', ts) AS datetime, CAST(user_id AS VARCHAR) AS crypto_id,
        round(value * 100) AS price, round(value * 100) + event_id % 7 + 1 AS volume,
        round(value * 100) * 3 + event_id % 11 AS market_cap FROM events""",
    "snapshot_by_date": f"{_BY_USER} WHERE timestamp < {HALF_WAY_MS}",
    "snapshot_by_series": f"""WITH {BY_TYPE} SELECT timestamp, crypto_id, price,
        CASE WHEN crypto_id = 'click' THEN volume + 1 ELSE volume END AS volume, market_cap
        FROM ticks""",
    "lookup_by_series": f"{_BY_USER} WHERE crypto_id IN ('7', '11')",
    "lookup_by_time": f"{_BY_USER} WHERE timestamp BETWEEN {HALF_WAY_MS} AND {HALF_WAY_MS} + 86400000",
    "legacy_snapshot_combined": _BY_TYPE,
    "legacy_snapshot_series_files": _BY_TYPE,
    "legacy_mixed_types": f"""WITH {BY_TYPE} SELECT timestamp, crypto_id, price,
        CASE WHEN crypto_id <> 'view' THEN volume END AS volume,
        CASE WHEN crypto_id <> 'purchase' THEN market_cap END AS market_cap FROM ticks""",
    "validate_ticks": f"WITH {CONTRACT} SELECT {TICK} FROM ticks WHERE reason IS NULL",
    "validate_ticks_rejects": f"""WITH {CONTRACT}
        SELECT crypto_id, timestamp, price, reason FROM ticks WHERE reason IS NOT NULL""",
    "append_rows": f"""WITH {BY_PART} SELECT {TICK} FROM ticks
        UNION ALL SELECT {TICK} FROM ticks WHERE l_returnflag = 'R'""",
    "append_skip_existing": SKIPPED,
    "append_by_day_skip_existing": f"""WITH {BY_USER}, unique_ticks AS (
            SELECT {TICK} FROM ticks QUALIFY row_number() OVER ({KEYED} ORDER BY {SURVIVOR}) = 1)
        SELECT {TICK} FROM unique_ticks UNION ALL
        SELECT min(timestamp) - 3650 * CAST(86400000 AS BIGINT), crypto_id, arg_min(price, timestamp), NULL, NULL
        FROM ticks GROUP BY crypto_id""",
    "append_skip_existing_bucketed": SKIPPED,
    "load_snapshot": _BY_USER,
    "ingest_top_k": f"""WITH {EXPLODED}, {_top(5)}, chosen AS (
            SELECT * FROM exploded WHERE crypto_id IN (SELECT id FROM top))
        SELECT {TICK} FROM chosen
        WHERE timestamp > {UNTIL_MS} - 7 * CAST(86400000 AS BIGINT) AND timestamp <= {UNTIL_MS}""",
    "written_bars": _DIRTY_METRICS,
    "run_counts": f"""WITH {DIRTY}, {CLEAN}, {BARS}, counted AS (
        SELECT (SELECT count(*) FROM ticks) AS raw, (SELECT count(*) FROM clean) AS clean,
               (SELECT count(*) FROM bars) AS bars)
        SELECT raw, raw - clean AS removed, clean, bars FROM counted""",
}
