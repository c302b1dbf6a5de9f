"""The queries of queries_contracts in SQL."""

from __future__ import annotations

from tickloom.oracle import _CALENDAR, _EVENTS, _PARTS, DAY, HOUR, _bars
from tickloom.oracle import ORACLES as MAIN

MINUTE = HOUR // 60
_OPEN, _CLOSED = 1704985200000000000, 1705190400000000000
_RESPONSE = ("validation_conflict", "entitlement_limited", "unsupported_resolution", "provider_unavailable", "source_gap", "excluded", "unknown")
_MAP = (_RESPONSE[1], _RESPONSE[0], *_RESPONSE[2:])

_SEGMENTS = """seg AS (SELECT c_custkey AS session, i, i * 100 + CASE WHEN c_custkey % 3 = 0 AND i = 1 THEN 5 ELSE 0 END AS s, i * 100 + 100 AS e,
  CASE WHEN (c_custkey + i) % 5 = 0 THEN 'partial' ELSE 'complete' END AS status, CASE WHEN c_custkey % 11 = 0 AND i = 2 THEN 1 ELSE 0 END AS crossed FROM customer, range(4) t(i))"""

#: Slices of the plans: ranks of the week's instances, and what each mode picks for them.
_PLAN = f"""{_CALENDAR}, pos AS (SELECT *, row_number() OVER (ORDER BY s) AS i, s <= {_OPEN} AND {_OPEN} < e AS active FROM inst),
rk AS (SELECT trade_date, phase, greatest(s, {_OPEN - 7 * DAY}) AS s, least(e, {_OPEN + DAY}) AS e, active, CASE WHEN i = a THEN 'new' WHEN i = a - 1 THEN 'buffer' WHEN i < a THEN 'old' END AS rank
  FROM pos, (SELECT max(i) FILTER (active) AS a FROM pos) WHERE s < {_OPEN + DAY} AND e > {_OPEN - 7 * DAY}),
pick AS (SELECT rk.*, mode, CASE WHEN rank IS NULL THEN NULL WHEN mode = 'futu_only' OR (mode = 'auto' AND rank <> 'old') THEN 'futu' ELSE 'alpaca' END AS provider
  FROM rk, (VALUES ('auto'), ('alpaca_only'), ('futu_only')) m(mode)),
ok AS (SELECT mode, s, e, phase, provider, CASE provider WHEN 'alpaca' THEN 'sip' END AS feed FROM pick WHERE provider IS NOT NULL AND phase <> 'after')"""


def _policy_case(name: str, now: int) -> str:
    """Permitted capabilities at one hour: every slice of the phase that the mode gives to the provider is recent."""
    return f"""SELECT '{name}' AS "case", mode, phase FROM (
  SELECT mode, phase, bool_and(rank IN ('new', 'buffer')) AS fine FROM (
    SELECT phase, mode, CASE WHEN a IS NOT NULL THEN CASE WHEN i = a THEN 'new' WHEN i = a - 1 THEN 'buffer' WHEN i < a THEN 'old' END ELSE CASE WHEN i = done THEN 'buffer' WHEN i < done THEN 'old' END END AS rank
    FROM (SELECT *, row_number() OVER (ORDER BY s) AS i FROM inst) p,
      (SELECT max(n) FILTER (s <= {now} AND {now} < e) AS a, max(n) FILTER (e <= {now}) AS done FROM (SELECT *, row_number() OVER (ORDER BY s) AS n FROM inst)) x, (VALUES ('auto'), ('futu_only')) m(mode)
    WHERE s < {now + DAY} AND e > {now - 3 * DAY}) r
  WHERE rank IS NOT NULL AND (mode = 'futu_only' OR rank <> 'old') GROUP BY mode, phase) WHERE fine AND phase <> 'after'"""


ORACLES: dict[str, str] = {
    "market_bar_violations": f"""WITH {_bars(DAY)}, b AS (SELECT *, (bar_start // {DAY} + symbol) % 7 AS n FROM bars), x AS (SELECT symbol, bar_start, n, open, low, close, CASE WHEN n = 3 THEN low - 1 ELSE high END AS high FROM b)
SELECT symbol, bar_start, 'volume' AS rule FROM x WHERE n = 1 UNION ALL SELECT symbol, bar_start, 'high_low' FROM x WHERE high < open OR high < close OR high < low
UNION ALL SELECT symbol, bar_start, 'start_before_end' FROM x WHERE n = 4 UNION ALL SELECT symbol, bar_start, 'ids' FROM x WHERE n = 5 UNION ALL SELECT symbol, bar_start, 'resolution' FROM x WHERE n = 6
UNION ALL SELECT symbol, bar_start, 'positive_price' FROM x WHERE open <= 0 OR high <= 0 OR low <= 0 OR close <= 0""",
    "trade_bar_violations": f"""WITH {_bars(MINUTE)}, b AS (SELECT *, (bar_start // {MINUTE} + symbol) % 16 AS n, bar_start % {DAY} = {DAY - MINUTE} AS last FROM bars),
x AS (SELECT symbol, bar_start, n, last, open, close, CASE WHEN n = 15 THEN -1 ELSE low END AS low, CASE WHEN n = 5 THEN low - 1 ELSE high END AS high, CASE WHEN n = 6 THEN 0 ELSE volume END AS volume FROM b),
fixed(n, rule) AS (VALUES (1, 'schema_version'), (2, 'window_in_session'), (3, 'source_in_bar'), (4, 'available_after_window'), (7, 'trades'), (8, 'counters'), (9, 'minutes'), (10, 'completion'), (11, 'quotes_excluded'), (12, 'labels'), (13, 'trade_date'), (14, 'bar_length'))
SELECT symbol, bar_start, rule FROM x JOIN fixed USING (n) UNION ALL SELECT symbol, bar_start, 'bar_in_window' FROM x WHERE n = 14 AND last
UNION ALL SELECT symbol, bar_start, 'high_low' FROM x WHERE high < open OR high < close OR low > open OR low > close UNION ALL SELECT symbol, bar_start, 'positive_price' FROM x WHERE low <= 0
UNION ALL SELECT symbol, bar_start, 'positive_volume' FROM x WHERE volume <= 0""",
    "grid_rules": f"""WITH {_bars(DAY)}, n AS (SELECT symbol, count(*) AS n, (max(bar_start) - min(bar_start)) // {DAY} + 1 AS expected, count(DISTINCT bar_start // {DAY} % 2) AS sides, bool_or(bar_start // {DAY} % 2 = 0) AS even FROM bars GROUP BY symbol)
SELECT symbol, CASE WHEN symbol % 35 = 4 THEN 'duplicate_bar' WHEN symbol % 5 = 2 AND sides = 2 THEN 'inconsistent_empty_minutes' WHEN symbol % 5 = 1 OR (symbol % 5 = 2 AND even) THEN 'undeclared_gap' WHEN symbol % 5 = 3 AND sides = 2 THEN 'several_windows' END AS rule
FROM n WHERE rule IS NOT NULL""",
    "event_rule_violations": f"""WITH {_EVENTS}, x AS (SELECT event_id, event_id % 9 AS n, kind, price FROM ev)
SELECT event_id, 'kind' AS rule FROM x WHERE kind = 'other' AND n = 0 UNION ALL SELECT event_id, 'entitlement' FROM x WHERE n = 1 UNION ALL SELECT event_id, 'encoding' FROM x WHERE n = 2
UNION ALL SELECT event_id, 'variant' FROM x WHERE CASE WHEN kind = 'trade' THEN n = 4 ELSE n = 3 END UNION ALL SELECT event_id, 'positive' FROM x WHERE kind = 'trade' AND (n IN (4, 5) OR price <= 0)""",
    "batch_violations": f"""WITH {_EVENTS}, x AS (SELECT symbol, event_id, CASE WHEN event_id % 41 <> 0 THEN ns END AS sent, ns + event_id % 3 * {DAY} AS got, CASE WHEN kind = 'other' THEN CASE WHEN event_id % 2 = 0 THEN 'control' ELSE 'else' END ELSE kind END AS kind FROM ev),
y AS (SELECT CASE WHEN sent IS NULL OR sent < 1704067200000000000 + {DAY} OR sent >= 1704067200000000000 + 21 * {DAY} OR got > 1704067200000000000 + 22 * {DAY} THEN 'IncompleteWindow' WHEN event_id % 43 = 0 THEN 'Contract'
  WHEN kind = 'else' THEN 'UnsupportedEvent' WHEN symbol >= 100 THEN 'UnexpectedSymbol' END AS rule FROM x WHERE kind <> 'control') SELECT rule, count(*) AS n FROM y WHERE rule IS NOT NULL GROUP BY rule""",
    "envelope_violations": "SELECT event_id, CASE WHEN event_id % 8 = 5 THEN 'InputLimit' ELSE 'Contract' END AS rule FROM events WHERE event_id % 8 BETWEEN 1 AND 6",
    "frame_order": """WITH f AS (SELECT event_type, event_id, (event_id // 3000 + 1 - CASE WHEN event_id % 211 = 0 THEN 1 ELSE 0 END) * 1000000000 + event_id - CASE WHEN event_id % 97 = 0 THEN 50 ELSE 0 END AS x FROM events),
l AS (SELECT *, lag(x) OVER (PARTITION BY event_type ORDER BY event_id) AS b FROM f) SELECT event_type, event_id FROM l WHERE b >= x""",
    "chunk_adjacency": """WITH c AS (SELECT o_orderkey // 2500 AS capture, o_orderkey // 500 AS generation, o_orderkey // 50 AS chunk, min(o_orderkey) AS a, max(o_orderkey) AS z FROM orders GROUP BY ALL),
b AS (SELECT capture, generation, a, z + CASE WHEN chunk % 7 = 0 THEN 1 ELSE 0 END AS z FROM c),
l AS (SELECT *, lag(generation) OVER w AS g, lag(z) OVER w AS y FROM b WINDOW w AS (PARTITION BY capture ORDER BY generation, a)) SELECT capture, generation, a AS "first", z AS "last" FROM l WHERE g = generation AND a <> y + 1""",
    "session_bounds": f"""WITH {_SEGMENTS} SELECT session, CAST(min(s) AS BIGINT) AS "start", CAST(max(e) AS BIGINT) AS "end" FROM seg GROUP BY session HAVING bool_and(status = 'complete') AND session % 3 <> 0""",
    "evidence_complete": f"""WITH {_SEGMENTS} SELECT session, bool_and(status = 'complete' AND session % 13 <> 0 AND crossed = 0) AND session % 3 <> 0 AS complete FROM seg WHERE e > 50 AND s < 250 GROUP BY session""",
    "sub_window": f"""WITH {_SEGMENTS}, ok AS (SELECT session FROM seg WHERE e <= 200 GROUP BY session HAVING bool_and(status = 'complete') AND session % 3 <> 0)
SELECT o_custkey AS session, o_orderkey, o_orderkey % 230 AS "start", o_orderkey % 230 + 10 AS "end" FROM orders WHERE o_custkey IN (SELECT session FROM ok) AND o_orderkey % 230 BETWEEN 20 AND 170""",
    "research_order": """WITH b AS (SELECT o_custkey AS symbol, o_orderkey, strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS event_ts_utc FROM orders)
SELECT * FROM b QUALIFY lag(event_ts_utc) OVER (PARTITION BY symbol ORDER BY o_orderkey) >= event_ts_utc""",
    "research_coverage": """WITH f AS (SELECT o_custkey AS symbol, count(*) AS n FROM orders GROUP BY ALL)
SELECT symbol, n, CASE WHEN symbol % 31 <> 0 THEN n + CASE WHEN symbol % 9 = 1 THEN 1 ELSE 0 END END AS declared_n FROM f WHERE symbol % 31 = 0 OR symbol % 9 IN (1, 2, 3) UNION ALL SELECT -1, NULL, 3""",
    "research_pages": """WITH r(n, rule) AS (VALUES (1, 'keys'), (2, 'fixed'), (3, 'status'), (4, 'range'), (5, 'symbols'), (6, 'bar_count'), (7, 'range'), (8, 'status'), (8, 'symbols')) SELECT p_partkey, rule FROM part JOIN r ON p_partkey % 9 = n""",
    "session_batch": f"""WITH {_PARTS}, s AS (SELECT coalesce(o.p_size, n.p_size) AS p_size, CASE WHEN o.p_partkey IS NULL THEN 'added' WHEN n.p_partkey IS NULL THEN 'removed' WHEN abs(n.price - o.price) > 0.01 OR n.p_brand <> o.p_brand THEN 'conflict' ELSE 'fine' END AS status
  FROM old o FULL JOIN new n ON o.p_partkey = n.p_partkey),
p AS (SELECT p_size, count(*) FILTER (status IN ('conflict', 'removed')) AS conflicts, count(*) AS compared FROM s GROUP BY p_size) SELECT *, (SELECT max(conflicts) > 0 FROM p) AS batch_rejected FROM p""",
    "shared_stretch": f"""WITH v AS (SELECT half, o_custkey AS session, epoch_ns(o_orderdate) AS s, min(o_orderstatus) AS state FROM orders, range(2) t(half) WHERE o_orderkey % 2 = half OR o_orderkey % 3 = 0 GROUP BY ALL),
w AS (SELECT session, max(a) AS a, min(b) AS b FROM (SELECT half, session, min(s) AS a, max(s) + {DAY} AS b FROM v GROUP BY half, session) GROUP BY session HAVING count(*) = 2 AND max(a) < min(b)),
i AS (SELECT v.* FROM v JOIN w USING (session) WHERE s >= w.a AND s + {DAY} <= w.b)
SELECT session, s AS "start", CASE WHEN count(*) FILTER (half = 0) = 0 THEN 'added' WHEN count(*) FILTER (half = 1) = 0 THEN 'removed' WHEN count(DISTINCT state) > 1 THEN 'conflict' ELSE 'equal' END AS status FROM i GROUP BY session, s""",
    "page_chain": """WITH p AS (SELECT conv_id, CAST(turn AS BIGINT) AS number, row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1 AS first FROM conversations)
SELECT conv_id, number FROM p WHERE (first AND number > 0) OR (NOT first AND ((conv_id % 6 = 1 AND number = 2) OR (conv_id % 6 = 3 AND number = 2) OR (conv_id % 6 = 2 AND number = 1)))""",
    "bag_match": """WITH l AS (SELECT CASE WHEN l_orderkey % 4 <> 0 THEN l_partkey % 50 END AS a, l_returnflag AS f, CASE WHEN l_orderkey % 1000 = 5 THEN 'Z' ELSE l_returnflag END AS g, l_linenumber FROM lineitem),
x AS (SELECT a, f, l_linenumber, count(*) AS n FROM l GROUP BY ALL), y AS (SELECT a, g, l_linenumber, count(*) AS n FROM l GROUP BY ALL)
SELECT coalesce(x.a, y.a) AS a, coalesce(f, g) AS l_returnflag, coalesce(x.l_linenumber, y.l_linenumber) AS l_linenumber, coalesce(x.n, 0) AS n_left, coalesce(y.n, 0) AS n_right
FROM x FULL JOIN y ON x.a IS NOT DISTINCT FROM y.a AND f = g AND x.l_linenumber = y.l_linenumber WHERE coalesce(x.n, 0) <> coalesce(y.n, 0)""",
    "plan_groups": f"""WITH {_PLAN}, live AS (SELECT mode, s, e, phase, provider, feed FROM ok UNION ALL SELECT mode, s, e, phase, provider, NULL FROM pick WHERE phase = 'after' AND provider = 'futu' AND active)
SELECT mode, provider, feed, '1m' AS interval, min(s) AS "start", max(e) AS "end", count(*) AS n_slices FROM live GROUP BY mode, provider, feed""",
    "plan_runs": f"""WITH {_PLAN}, k AS (SELECT *, row_number() OVER (PARTITION BY mode ORDER BY s DESC) - row_number() OVER (PARTITION BY mode, provider, feed ORDER BY s DESC) AS g FROM ok),
r AS (SELECT mode, provider, feed, min(s) AS oldest_start, max(s) AS newest_start, count(*) AS n_slices FROM k GROUP BY mode, provider, feed, g)
SELECT mode, CAST(row_number() OVER (PARTITION BY mode ORDER BY newest_start DESC) AS BIGINT) AS run, provider, feed, oldest_start, newest_start, n_slices FROM r""",
    "provider_policy": f"""WITH {_CALENDAR}, ok AS ({_policy_case("open", _OPEN)} UNION ALL {_policy_case("closed", _CLOSED)}),
every AS (SELECT c AS "case", m AS mode, phase FROM (VALUES ('open'), ('closed')) t(c), (VALUES ('auto'), ('futu_only'), ('alpaca_only')) u(m), (VALUES ('pre'), ('regular'), ('after')) v(phase))
SELECT "case", mode, 'futu' AS provider, phase FROM ok UNION ALL SELECT "case", mode, 'alpaca', phase FROM every""",
    "null_volume_gaps": f"""WITH {_bars(HOUR)}, r AS (SELECT 1704887000000000000 AS a, 1705500000000000000 AS b), x AS (SELECT *, trade_count + symbol % 3 = 3 AS bare FROM bars)
SELECT greatest(bar_start, a) AS "start", least(bar_start + {HOUR}, b) AS "end", 'unknown' AS reason, count(*) AS n FROM x, r WHERE bare AND bar_start < b AND bar_start + {HOUR} > a GROUP BY ALL
UNION ALL SELECT 0, 0, 'rows', count(*) FROM x WHERE NOT bare""",
    "scalar_checks": f"""WITH p AS (SELECT p_partkey AS k, ['SPY', 'TOOLONGS', ''][p_partkey % 3 + 1] || '240119' || ['C', 'P', 'X', 'C'][p_partkey % 4 + 1] || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS option,
  '2024-' || ['02', '2'][p_partkey % 2 + 1] || '-' || lpad(CAST(p_partkey % 32 AS VARCHAR), 2, '0') AS date, ['1m', '5m', '15m', '1h', '1d', '1w'][p_partkey % 6 + 1] AS res,
  {list(_MAP) + ["other"]}[p_partkey % 8 + 1] AS reason, ['Alpaca', 'futu', 'Mixed'][p_partkey % 3 + 1] AS x, ['alpaca', 'FUTU'][p_partkey % 2 + 1] AS y,
  ['pre', 'regular', 'after', 'over'][p_partkey % 4 + 1] AS phase, ['all', 'regular', 'extended', 'overnight', 'none'][p_partkey % 5 + 1] AS scope FROM part),
w AS (SELECT *, CASE res WHEN '1m' THEN 1 WHEN '5m' THEN 5 WHEN '15m' THEN 15 WHEN '1h' THEN 60 WHEN '1d' THEN 1440 END * {MINUTE} AS width FROM p)
SELECT k AS p_partkey, regexp_full_match(option, '[A-Z]{{1,6}}[0-9]{{6}}[CP][0-9]{{8}}') AS option, length(date) = 10 AND coalesce(try_cast(date AS DATE), NULL) IS NOT NULL AS date, width,
  CASE WHEN res = '1d' THEN k * {MINUTE} + 20 * {MINUTE} WHEN width IS NULL THEN k * {MINUTE} + 20 * {MINUTE} ELSE least(k * {MINUTE} + width, k * {MINUTE} + 20 * {MINUTE}) END AS bar_end,
  CAST(7 - nullif(list_position({list(_RESPONSE)}, reason), 0) AS INTEGER) AS priority, CASE WHEN x = 'Mixed' THEN NULL ELSE lower(x) = lower(y) END AS same,
  scope = 'all' OR (scope = 'regular' AND phase = 'regular') OR (scope = 'extended' AND phase IN ('pre', 'after')) OR (scope = 'overnight' AND phase = 'over') AS scope FROM w""",
    "overnight_routes": """WITH c AS (SELECT s_suppkey, ['a', 'b', 'c'][s_suppkey % 3 + 1] AS provider, ['x', NULL, 'y', 'z', 'x'][s_suppkey % 5 + 1] AS feed, ['pre', 'regular', 'after', 'over'][s_suppkey % 4 + 1] AS phase FROM supplier)
SELECT * FROM c WHERE phase <> 'over' OR (provider = 'a' AND feed = 'x') OR (provider = 'b' AND feed IS NULL)""",
    "key_fingerprints": """WITH p AS (SELECT c_custkey, unnest(['cache-key-v1', 'limit', CAST(c_nationkey AS VARCHAR), 'mode', 'auto', 'symbol', c_name]) AS x, unnest(range(7)) AS i FROM customer),
h AS (SELECT c_custkey, string_agg(lpad(lower(hex(strlen(x))), 16, '0') || lower(hex(x)), '' ORDER BY i) AS h FROM p GROUP BY c_custkey) SELECT c_custkey, sha256(unhex(h)) AS fingerprint FROM h""",
    "sources_of_bars": f"""WITH f AS (SELECT count(*) AS n_rows, count(DISTINCT c_nationkey) AS n_symbols, min(c_custkey) * {MINUTE} AS source_start, max(c_custkey) * {MINUTE} AS source_end, CAST(0 AS BIGINT) AS missing_times, count(*) = count(DISTINCT c_custkey) AS unique_key,
  count(DISTINCT c_mktsegment) = 1 AS one FROM customer)
SELECT n_rows, n_symbols, source_start, source_end, missing_times, unique_key, c = 'none' OR one AS single_source, c AS "case" FROM f, (VALUES ('segment'), ('none')) t(c)""",
    "stream_bars_to_end": f"""WITH {_bars(HOUR)}
SELECT symbol AS user_id, bar_start, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, CAST(volume AS DOUBLE) AS volume, trade_count FROM bars""",
    "capture_rollup": """WITH n AS (SELECT o_custkey AS capture, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders),
c AS (SELECT capture, i, i // 4 + 1 AS g, i % 4 * 10 + 1 + CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END AS a, i % 4 * 10 + 10 AS b, sha256(CAST(o_orderkey AS VARCHAR)) AS digest FROM n),
l AS (SELECT *, lag(g) OVER w AS pg, lag(b) OVER w AS pb FROM c WINDOW w AS (PARTITION BY capture ORDER BY i))
SELECT capture, min(g) AS first_generation, arg_min(a, i) AS first_number, max(g) AS last_generation, arg_max(b, i) AS last_number, count(*) AS n_chunks, CAST(count(*) * 10 AS BIGINT) AS n_frames,
  sha256(string_agg(digest, chr(10) ORDER BY i)) AS digest, CAST(count(*) FILTER (CASE WHEN pg IS NULL THEN a <> 1 WHEN pg = g THEN a <> pb + 1 ELSE a <> 1 END) AS BIGINT) AS broken FROM l GROUP BY capture""",
    "stream_accounts": "SELECT user_id, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY user_id",
    "stream_sequence": MAIN["sequence_classes"],
}
