"""The queries in ANSI SQL, formulated apart from the DataFrame code, for a second engine."""

from __future__ import annotations

HOUR, DAY = 3_600_000_000_000, 86_400_000_000_000

_EVENTS = """ev AS (
  SELECT user_id AS symbol, event_id, event_type, epoch_ns(ts) AS ns, props, CAST(value AS DECIMAL(18,4)) AS price, CAST(json_extract_string(props, '$.k') AS BIGINT) AS size,
         CASE event_type WHEN 'purchase' THEN 'trade' WHEN 'view' THEN 'quote' ELSE 'other' END AS kind
  FROM events)"""


def _bars(width: int) -> str:
    return f"""{_EVENTS}, bars AS (
  SELECT symbol, ns - ns % {width} AS bar_start,
         arg_min(price, (ns, event_id)) FILTER (kind = 'trade') AS open, max(price) FILTER (kind = 'trade') AS high, min(price) FILTER (kind = 'trade') AS low,
         arg_max(price, (ns, event_id)) FILTER (kind = 'trade') AS close, sum(size) FILTER (kind = 'trade') AS volume, count(*) FILTER (kind = 'trade') AS trade_count,
         count(*) FILTER (kind = 'quote') AS quote_events_excluded, min(ns) FILTER (kind = 'trade') AS source_start, max(ns) FILTER (kind = 'trade') + 1 AS source_end
  FROM ev WHERE kind <> 'other' GROUP BY ALL HAVING count(*) FILTER (kind = 'trade') > 0)"""


_CALENDAR = f"""days AS (
  SELECT d FROM (SELECT unnest(generate_series((SELECT CAST(min(ts) AS DATE) FROM events), (SELECT CAST(max(ts) AS DATE) + 1 FROM events), INTERVAL 1 DAY)) AS d)
  WHERE dayofweek(d) NOT IN (0, 6) AND d NOT IN (DATE '2024-01-01', DATE '2024-01-15')),
inst AS (
  SELECT 'XNYS:' || strftime(d, '%Y-%m-%d') || ':' || p AS session_instance_id, strftime(d, '%Y-%m-%d') AS trade_date, p AS phase,
         epoch_ns(CAST(d AS TIMESTAMP)) + a * {HOUR // 2} AS s, epoch_ns(CAST(d AS TIMESTAMP)) + b * {HOUR // 2} AS e
  FROM days, (VALUES ('pre', 18, 29), ('regular', 29, 42), ('after', 42, 50)) AS t(p, a, b))"""

_MAP = ("entitlement_limited", "validation_conflict", "unsupported_resolution", "provider_unavailable", "source_gap", "excluded", "unknown")
_RESPONSE = (_MAP[1], _MAP[0], *_MAP[2:])

_GAPS = f"""gaps AS (
  SELECT o_custkey AS key, o_orderkey AS id, epoch_ns(o_orderdate) AS s, epoch_ns(o_orderdate) + (o_orderkey % 200 + 1) * {DAY} AS e,
         CASE o_orderkey % 7 {' '.join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(_MAP))} END AS reason
  FROM orders)"""


def normalized_from(order: tuple[str, ...], key: str = "key") -> str:
    """Common table expressions and the query that normalise a table gaps (key, s, e, reason)."""
    rank = " ".join(f"WHEN '{r}' THEN {i}" for i, r in enumerate(order))
    name = " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(order))
    return f"""cuts AS (SELECT key, s AS t FROM gaps UNION SELECT key, e FROM gaps),
pieces AS (SELECT key, t AS a, lead(t) OVER (PARTITION BY key ORDER BY t) AS b FROM cuts),
top AS (SELECT p.key, a, b, min(CASE reason {rank} END) AS r FROM pieces p JOIN gaps g ON g.key = p.key AND g.s <= a AND g.e >= b WHERE b IS NOT NULL GROUP BY ALL),
marked AS (SELECT *, CASE WHEN lag(b) OVER w = a AND lag(r) OVER w = r THEN 0 ELSE 1 END AS fresh FROM top WINDOW w AS (PARTITION BY key ORDER BY a)),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY key ORDER BY a) AS run FROM marked)
SELECT {key}, min(a) AS "start", max(b) AS "end", CASE min(r) {name} END AS reason FROM runs GROUP BY key, run"""


def _normalized(order: tuple[str, ...]) -> str:
    return f"WITH {_GAPS}, {normalized_from(order)}"


_YEARS = """years AS (SELECT c_custkey AS key, y AS year, CAST(a AS BIGINT) * 1000000000 AS s, CAST(b AS BIGINT) * 1000000000 AS e FROM customer, (VALUES (1996, 820454400, 852076800), (1999, 915148800, 946684800)) AS t(y, a, b))"""


def _uncovered(windows: str, covers: str, ids: str) -> str:
    """Islands of the clipped covers first, then what lies before, between and after them."""
    k = ", ".join(ids.split())
    return f"""c AS (SELECT DISTINCT {', '.join('w.' + x for x in ids.split())}, w.s AS ws, w.e AS we, greatest(w.s, g.s) AS s, least(w.e, g.e) AS e FROM {windows} w JOIN {covers} g ON g.key = w.key AND g.s < w.e AND w.s < g.e AND g.s < g.e),
m AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY {k}, ws, we ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM c),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY {k}, ws, we ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS n FROM m),
u AS (SELECT {k}, ws, we, n, min(s) AS s, max(e) AS e FROM i GROUP BY ALL),
bare AS (
  SELECT {k}, ws AS a, min(s) AS b FROM u GROUP BY {k}, ws, we
  UNION ALL SELECT {k}, e, coalesce(lead(s) OVER (PARTITION BY {k}, ws, we ORDER BY s), we) FROM u
  UNION ALL SELECT DISTINCT {k}, s, e FROM {windows} w WHERE NOT EXISTS (SELECT 1 FROM {covers} g WHERE g.key = w.key AND g.s < w.e AND w.s < g.e AND g.s < g.e))"""


_PARTS = """old AS (SELECT p_partkey, CAST(p_retailprice AS DECIMAL(18,4)) AS price, p_brand, p_size FROM part),
new AS (
  SELECT p_partkey, CAST(price + CASE WHEN p_partkey % 25 = 0 THEN 1 WHEN p_partkey % 10 = 0 THEN 0.005 ELSE 0 END AS DECIMAL(18,4)) AS price,
         CASE WHEN p_partkey % 90 = 0 THEN 'Brand#X' ELSE p_brand END AS p_brand, p_size FROM old WHERE p_partkey % 40 <> 7
  UNION ALL SELECT p_partkey + 10000000, price, p_brand, p_size FROM old WHERE p_partkey % 50 = 1),
cmp AS (
  SELECT coalesce(o.p_partkey, n.p_partkey) AS p_partkey,
         CASE WHEN o.p_partkey IS NULL THEN 'added' WHEN n.p_partkey IS NULL THEN 'removed' WHEN abs(n.price - o.price) > 0.01 OR n.p_brand <> o.p_brand OR n.p_size <> o.p_size THEN 'conflict'
              WHEN n.price <> o.price THEN 'tolerated' ELSE 'equal' END AS status,
         CASE WHEN o.p_partkey IS NOT NULL AND n.p_partkey IS NOT NULL AND n.price <> o.price THEN 1 ELSE 0 END AS changed_fields
  FROM old o FULL JOIN new n ON o.p_partkey = n.p_partkey)"""

_SEQ = """seq AS (
  SELECT event_type AS feed, event_id // 3000 + 1 AS generation, event_id AS sequence,
         (event_id + CASE WHEN event_id % 97 = 0 THEN 5000 WHEN event_id % 2 = 0 THEN 3 ELSE 0 END) * 100000000 + event_id AS arrival FROM events),
st AS (SELECT *, max(generation * 1000000000 + sequence) OVER (PARTITION BY feed ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM seq),
cls AS (
  SELECT *, CASE WHEN b IS NULL OR generation > b // 1000000000 THEN 'accept' WHEN generation < b // 1000000000 THEN 'stale_generation'
                 WHEN sequence <= b % 1000000000 THEN 'duplicate_or_reordered' WHEN sequence > b % 1000000000 + 1 THEN 'gap' ELSE 'accept' END AS decision FROM st)"""

ORACLES: dict[str, str] = {
    "bars_ohlcv": f"""WITH {_bars(HOUR)} SELECT symbol, bar_start, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close,
  CAST(volume AS DOUBLE) AS volume, trade_count, source_start, source_end FROM bars""",
    "bars_with_quote_counts": f"WITH {_bars(DAY)} SELECT symbol, bar_start, trade_count, quote_events_excluded FROM bars",
    "bars_sparse_grid": f"""WITH {_bars(DAY)}, span AS (SELECT symbol, min(bar_start) AS a, max(bar_start) AS b FROM bars GROUP BY symbol),
grid AS (SELECT symbol, unnest(range(a, b + 1, {DAY})) AS bar_start FROM span) SELECT symbol, bar_start FROM grid EXCEPT SELECT symbol, bar_start FROM bars""",
    "bar_rule_violations": f"""WITH {_bars(DAY)}, bent AS (SELECT *, (bar_start // {DAY} + symbol) % 7 AS n FROM bars),
x AS (SELECT symbol, bar_start, open, close, low, CASE WHEN n = 1 THEN low - 1 ELSE high END AS high, CASE WHEN n = 2 THEN 0 ELSE volume END AS volume, source_start, CASE WHEN n = 3 THEN bar_start + 2 * {DAY} ELSE source_end END AS source_end FROM bent)
SELECT symbol, bar_start, 'high_low' AS rule FROM x WHERE high < open OR high < close OR low > open OR low > close
UNION ALL SELECT symbol, bar_start, 'positive_volume' FROM x WHERE volume <= 0
UNION ALL SELECT symbol, bar_start, 'source_in_bar' FROM x WHERE source_start < bar_start OR source_end > bar_start + {DAY}""",
    "dataset_facts": """SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_symbols, min(epoch_ns(ts)) AS source_start, max(epoch_ns(ts)) + 1 AS source_end, CAST(count(*) FILTER (ts IS NULL) AS BIGINT) AS missing_times,
  count(*) = count(DISTINCT (user_id, ts)) AS unique_key, true AS single_source FROM events""",
    "source_label_summary": f"""WITH {_EVENTS}, p AS (SELECT symbol, ns // {DAY} AS day, CASE kind WHEN 'trade' THEN 'a' WHEN 'quote' THEN 'b' END AS provider FROM ev)
SELECT symbol, day, CASE count(DISTINCT provider) WHEN 0 THEN 'unknown' WHEN 1 THEN min(provider) ELSE 'mixed' END AS label FROM p GROUP BY ALL""",
    "sequence_gaps": """WITH l AS (SELECT event_type AS feed, event_id AS sequence, lag(event_id) OVER (PARTITION BY event_type ORDER BY event_id) AS b FROM events)
SELECT feed, sequence, b + 1 AS missing_first, sequence - 1 AS missing_last FROM l WHERE sequence > b + 1""",
    "sequence_classes": f"WITH {_SEQ} SELECT feed, decision, count(*) AS n, CAST(sum(sequence) AS BIGINT) AS sequence_sum FROM cls GROUP BY ALL",
    "phase_assignment": f"""WITH {_CALENDAR}, r AS (SELECT event_id, epoch_ns(ts) AS s, epoch_ns(ts) + 60000000000 AS e FROM events)
SELECT event_id, CASE WHEN count(i.s) = 1 THEN min(session_instance_id) END AS session_instance_id FROM r LEFT JOIN inst i ON r.s >= i.s AND r.e <= i.e GROUP BY event_id""",
    "session_rank": f"""WITH {_CALENDAR}, cases(c, now) AS (VALUES ('open', 1704985200000000000), ('closed', 1705190400000000000)),
p AS (SELECT c, now, inst.*, row_number() OVER (PARTITION BY c ORDER BY s) AS position, s <= now AND now < e AS active FROM inst, cases),
q AS (SELECT *, (SELECT max(position) FROM p x WHERE x.c = p.c AND x.active) AS a, (SELECT max(position) FROM p x WHERE x.c = p.c AND x.e <= now) AS done FROM p)
SELECT c AS "case", session_instance_id, CAST(position AS INTEGER) AS position, active,
  CASE WHEN a IS NOT NULL THEN CASE WHEN position = a THEN 'new' WHEN position = a - 1 THEN 'buffer' WHEN position < a THEN 'old' END
       ELSE CASE WHEN position = done THEN 'buffer' WHEN position < done THEN 'old' END END AS rank FROM q""",
    "asof_session": """WITH i AS (SELECT m, strftime(m, '%Y-%m') AS instance FROM (SELECT unnest(generate_series(DATE '1995-02-01', DATE '2001-06-01', INTERVAL 1 MONTH)) AS m))
SELECT o_orderkey, instance FROM orders ASOF LEFT JOIN i ON o_orderdate >= m""",
    "provider_runs": """WITH k AS (SELECT user_id AS symbol, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS g
  FROM events WHERE event_type <> 'error'),
r AS (SELECT symbol, event_type, min(event_id) AS first_id, max(event_id) AS last_id, count(*) AS n_slices FROM k GROUP BY symbol, event_type, g)
SELECT symbol, CAST(row_number() OVER (PARTITION BY symbol ORDER BY first_id) AS BIGINT) AS run, event_type, first_id, last_id, n_slices FROM r""",
    "route_choice": f"""WITH {_CALENDAR}, p AS (SELECT trade_date, phase, row_number() OVER (ORDER BY s) AS i, CASE WHEN s <= 1704985200000000000 AND e > 1704985200000000000 THEN row_number() OVER (ORDER BY s) END AS act FROM inst),
s AS (SELECT trade_date, phase, CASE WHEN i = a THEN 'new' WHEN i = a - 1 THEN 'buffer' WHEN i < a THEN 'old' END AS rank FROM (SELECT *, max(act) OVER () AS a FROM p)
  UNION ALL VALUES ('2015-12-31', 'regular', 'old'), ('2015-12-31', 'over', 'old'), ('2024-01-11', 'over', 'new')),
g AS (SELECT * FROM s, (VALUES ('auto'), ('alpaca_only'), ('futu_only'), ('research')) m(mode), (VALUES ('1m'), ('1d')) n(interval)),
c AS (SELECT *, CASE WHEN rank IS NULL THEN 'future_session' WHEN trade_date < '2016-01-01' AND interval = '1d' AND mode IN ('alpaca_only', 'futu_only') THEN 'source_mode_excludes_required_provider' END AS g0 FROM g),
d AS (SELECT *, CASE WHEN g0 IS NOT NULL THEN NULL WHEN mode = 'research' OR (trade_date < '2016-01-01' AND interval = '1d') THEN 'yfinance'
                     WHEN mode = 'futu_only' OR (mode = 'auto' AND rank <> 'old') THEN 'futu' ELSE 'alpaca' END AS provider FROM c),
f AS (SELECT *, CASE provider WHEN 'yfinance' THEN 'daily' WHEN 'alpaca' THEN CASE WHEN phase = 'over' THEN 'boats' ELSE 'sip' END END AS feed FROM d),
caps(cp, cf, cph, ci, h) AS (VALUES ('futu', NULL, 'regular', '1m', true), ('alpaca', 'sip', 'regular', '1m', true), ('alpaca', 'sip', 'pre', '1m', false))
SELECT trade_date, phase, mode, interval, provider, feed, CASE WHEN g0 IS NOT NULL THEN g0 WHEN coalesce(h, false) THEN NULL ELSE 'missing_provider_capability' END AS gap, coalesce(h, false) AS historical
FROM f LEFT JOIN caps ON provider IS NOT DISTINCT FROM cp AND feed IS NOT DISTINCT FROM cf AND phase IS NOT DISTINCT FROM cph AND interval IS NOT DISTINCT FROM ci""",
    "gap_normalize_map": _normalized(_MAP),
    "gap_normalize_response": _normalized(_RESPONSE),
    "gap_merge": f"""WITH {_GAPS}, m AS (SELECT *, CASE WHEN s < max(e) OVER (PARTITION BY key ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM gaps),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY key ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS n FROM m)
SELECT key, min(s) AS "start", max(e) AS "end", CASE WHEN count(*) > 1 THEN 'unknown' ELSE min(reason) END AS reason FROM i GROUP BY key, n""",
    "uncovered_windows": f'WITH {_GAPS}, {_YEARS}, {_uncovered("years", "gaps", "key year")} SELECT key, CAST(year AS INTEGER) AS year, a AS "start", b AS "end" FROM bare WHERE a < b',
    "segment_minus_gap": f"""WITH {_GAPS}, seg AS (SELECT id AS key, s, e FROM gaps), ship AS (SELECT l_orderkey AS key, epoch_ns(l_shipdate) AS s, epoch_ns(l_shipdate) + 3 * {DAY} AS e FROM lineitem),
{_uncovered("seg", "ship", "key")} SELECT key, a AS "start", b AS "end" FROM bare WHERE a < b""",
    "coverage_status": f"""WITH {_GAPS}, {_YEARS}, {_uncovered("years", "gaps", "key year")},
b AS (SELECT y.key, y.year, y.e - y.s AS size, CAST(coalesce(sum(b - a) FILTER (a < b), 0) AS BIGINT) AS bare FROM years y LEFT JOIN bare ON bare.key = y.key AND bare.year = y.year GROUP BY ALL)
SELECT key, CAST(year AS INTEGER) AS year, bare, CASE WHEN bare = 0 THEN 'complete' WHEN bare >= size THEN 'empty' ELSE 'partial' END AS status FROM b""",
    "tiling_complete": f"""WITH b AS (SELECT DISTINCT user_id % 8 AS grp, event_type, epoch_ns(ts) // {6 * HOUR} AS q FROM events)
SELECT grp, event_type, q // 4 * {DAY} AS day, count(*) AS n_bars, count(*) = 4 AS complete FROM b GROUP BY grp, event_type, q // 4""",
    "overlap_conflicts": f"WITH {_GAPS} SELECT DISTINCT a.key, a.id FROM gaps a JOIN gaps b ON a.key = b.key AND a.id <> b.id AND a.s < b.e AND b.s < a.e",
    "bars_outside_gaps": f"""WITH {_bars(HOUR)}, g AS (SELECT symbol, ns AS s, ns + 12 * {HOUR} AS e FROM ev WHERE event_type = 'error')
SELECT symbol AS key, bar_start AS "start", bar_start + {HOUR} AS "end" FROM bars b WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.symbol = b.symbol AND g.s < b.bar_start + {HOUR} AND b.bar_start < g.e)""",
    "gaps_on_slices": f"""WITH {_GAPS}, {_YEARS} SELECT g.key, g.id, greatest(g.s, y.s) AS "start", least(g.e, y.e) AS "end", reason FROM gaps g JOIN years y ON g.key = y.key AND g.s < y.e AND y.s < g.e""",
    "boundary_bars": f"""WITH {_bars(HOUR)}, r AS (SELECT 1704887000000000000 AS a, 1705500000000000000 AS b)
SELECT greatest(bar_start, a) AS "start", least(bar_start + {HOUR}, b) AS "end", 'unknown' AS reason FROM bars, r WHERE (bar_start < a AND bar_start + {HOUR} > a) OR (bar_start < b AND bar_start + {HOUR} > b)""",
    "reconcile_compare": f"WITH {_PARTS} SELECT p_partkey, status, CAST(changed_fields AS INTEGER) AS changed_fields FROM cmp",
    "reconcile_verdict": f"""WITH {_PARTS}, n AS (SELECT count(*) FILTER (status = 'added') AS added, count(*) FILTER (status = 'removed') AS removed, count(*) FILTER (status = 'conflict') AS conflict,
  count(*) FILTER (status = 'tolerated') AS tolerated, count(*) FILTER (status = 'equal') AS equal, CAST(sum(changed_fields) AS BIGINT) AS changed_fields FROM cmp)
SELECT *, conflict = 0 AND added <= 1000 AND tolerated <= 100000 AS accepted FROM n""",
    "dedupe_conflicts": """WITH r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 3 <> 0 THEN l_partkey % 5 END AS a, CASE WHEN l_partkey % 3 = 0 THEN l_partkey % 5 END AS b, l_returnflag FROM lineitem)
SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count(DISTINCT coalesce(CAST(a AS VARCHAR), '-') || '/' || coalesce(CAST(b AS VARCHAR), '-') || '/' || l_returnflag) AS n_payloads FROM r GROUP BY l_orderkey, l_linenumber HAVING n_payloads > 1""",
    "dedupe_min_encoding": """WITH d AS (SELECT sha256(text) AS identity, doc_id, source || '|' || lang || '|' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS encoding FROM documents)
SELECT identity, doc_id, encoding FROM d QUALIFY row_number() OVER (PARTITION BY identity ORDER BY encoding) = 1""",
    "lineage_orphans": """WITH l AS (SELECT CASE WHEN l_orderkey % 7 = 0 THEN -l_orderkey - 1 ELSE l_orderkey END AS l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem)
SELECT * FROM l WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)""",
    "pair_completeness": """WITH e AS (SELECT l_orderkey AS frame, count(*) AS n_events, count(DISTINCT l_linenumber) AS n_ordinals FROM lineitem GROUP BY ALL)
SELECT coalesce(o_orderkey, frame) AS frame, o_orderkey % 6 AS declared, coalesce(n_events, 0) AS n_events, coalesce(n_ordinals, 0) AS n_ordinals,
  coalesce(coalesce(n_events, 0) = o_orderkey % 6 AND coalesce(n_ordinals, 0) = o_orderkey % 6, false) AS complete FROM orders FULL JOIN e ON o_orderkey = frame""",
    "turn_contiguity": """WITH b AS (SELECT conv_id, CASE WHEN conv_id % 5 = 0 AND turn >= 3 THEN turn + 1 WHEN conv_id % 7 = 0 AND turn = 3 THEN turn - 1 ELSE turn END AS turn FROM conversations),
c AS (SELECT conv_id, turn, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS after FROM b)
SELECT conv_id, CAST(min(turn) AS BIGINT) AS first_turn, CAST(max(turn) AS BIGINT) AS last_turn, count(*) AS n_rows, count(*) FILTER (after <> turn + 1) = 0 AS contiguous FROM c GROUP BY conv_id""",
    "keyset_page": """SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey, o_totalprice FROM orders WHERE (strftime(o_orderdate, '%Y-%m-%d'), o_orderkey) < ('2000-06-15', 500) ORDER BY 1 DESC, 2 DESC LIMIT 100""",
    "session_set_digest": f"""WITH g AS (SELECT user_id AS symbol, epoch_ns(ts) // {DAY} AS day, list_sort(list(DISTINCT event_type)) AS l FROM events GROUP BY ALL)
SELECT symbol, day, CASE WHEN len(l) = 1 THEN l[1] ELSE sha256(array_to_string(l, chr(10))) END AS digest FROM g""",
    "json_shape_violations": """WITH b AS (SELECT event_id, CASE event_id % 10 WHEN 0 THEN '{"k": 1, "k": 2}' WHEN 1 THEN '{"k": 1, "x": 2}' WHEN 2 THEN '{}' ELSE props END AS props FROM events)
SELECT event_id, props FROM b WHERE NOT regexp_full_match(props, '\\{"k": [0-9]+\\}')""",
    "token_checks": """WITH t AS (SELECT *, CASE WHEN p_partkey % 3 = 0 THEN upper(replace(p_name, ' ', '.')) ELSE p_name END AS token, CASE p_partkey % 4 WHEN 0 THEN '01.5' WHEN 1 THEN '1.50' WHEN 2 THEN '0' ELSE '-2' END AS number FROM part)
SELECT p_partkey, regexp_full_match(token, '[A-Z0-9.-]{1,32}') AS ticker, strlen(token) BETWEEN 1 AND 10 AND trim(token) = token AS label, number = '1.50' AS positive, number IN ('1.50', '0') AS non_negative, true AS sha FROM t""",
    "rfc3339_round_trip": """WITH e AS (SELECT event_id, epoch_ns(ts) + event_id % 1000 AS ns FROM events),
f AS (SELECT *, rtrim(lpad(CAST(ns % 1000000000 AS VARCHAR), 9, '0'), '0') AS frac, strftime(make_timestamp(ns // 1000000000 * 1000000), '%Y-%m-%dT%H:%M:%S') AS head FROM e)
SELECT event_id, head || CASE WHEN frac = '' THEN '' ELSE '.' || frac END || 'Z' AS text, ns FROM f""",
    "decimal_normal_form": "SELECT p_partkey, regexp_replace(regexp_replace(CAST(CAST(p_retailprice AS DECIMAL(18,4)) AS VARCHAR), '0+$', ''), '\\.$', '') AS price FROM part",
    "digests": """WITH p AS (SELECT c_custkey, unnest(['customer-v1', c_name, c_mktsegment]) AS x, unnest([1, 2, 3]) AS i FROM customer),
h AS (SELECT c_custkey, string_agg(lpad(lower(hex(strlen(x))), 16, '0') || lower(hex(x)), '' ORDER BY i) AS h FROM p GROUP BY c_custkey) SELECT c_custkey, sha256(unhex(h)) AS digest FROM h""",
    "month_shards": """WITH g AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS session, count(*) AS n_orders FROM orders GROUP BY ALL),
n AS (SELECT *, (row_number() OVER (PARTITION BY month ORDER BY session) - 1) // 64 AS k FROM g)
SELECT month, session, n_orders, month || '-' || lpad(CAST(k AS VARCHAR), 4, '0') AS shard_id, CASE WHEN sum(n_orders * 4000) OVER (PARTITION BY month, k) > 262144 THEN 'InputLimit' END AS rule FROM n""",
    "symbol_partition": """WITH c AS (SELECT c_custkey AS k, [CAST(c_custkey % 5 AS VARCHAR), CAST(c_custkey % 7 + 10 AS VARCHAR), '20'] AS asked FROM customer),
p AS (SELECT k, asked, CASE WHEN k % 4 = 0 THEN asked ELSE asked[1:2] END AS given, CASE WHEN k % 6 = 0 THEN ['20', '21'] WHEN k % 4 = 0 THEN [] ELSE ['20'] END AS lost FROM c)
SELECT k AS c_custkey, len(given) AS n_returned, len(lost) AS n_missing, len(list_intersect(given, lost)) = 0 AND list_sort(list_distinct(list_concat(given, lost))) = list_sort(asked) AS holds FROM p""",
    "authority": """WITH k AS (SELECT o_orderkey AS o FROM orders)
SELECT o AS o_orderkey, CASE WHEN o % 2 = 0 AND (o // 2) % 3 IN (0, 2) AND o % 5 <> 0 AND o % 11 > 0 AND o % 13 <> 0 AND
  (((o // 3) % 2 = 0 AND (o // 4) % 2 = 0) OR ((o // 3) % 2 = 1 AND (o // 4) % 2 = 1 AND (o // 5) % 2 = 0)) THEN 'authoritative' ELSE 'provisional' END AS authority FROM k""",
    "coverage_intersection": f"""WITH {_GAPS}, b AS (SELECT key, id % 2 AS half, min(s) AS s, max(e) AS e FROM gaps GROUP BY ALL)
SELECT key AS session, max(s) AS "start", min(e) AS "end" FROM b GROUP BY key HAVING count(*) = 2 AND max(s) < min(e)""",
    "chunk_rollup": """WITH r AS (SELECT l_orderkey // 100 AS chunk, l_orderkey AS o, l_linenumber AS n, l_partkey AS p, l_suppkey AS s,
  sha256('{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || ',"l_partkey":' || l_partkey || ',"l_suppkey":' || l_suppkey || '}') AS h FROM lineitem),
c AS (SELECT chunk, count(*) AS n_rows, sha256(string_agg(h, chr(10) ORDER BY o, n, p, s)) AS digest FROM r GROUP BY chunk),
l1 AS (SELECT chunk // 64 AS k, sha256(string_agg(digest, chr(10) ORDER BY chunk)) AS d FROM c GROUP BY ALL),
l2 AS (SELECT k // 64 AS k2, sha256(string_agg(d, chr(10) ORDER BY k)) AS d FROM l1 GROUP BY ALL),
l3 AS (SELECT k2 // 64 AS k3, sha256(string_agg(d, chr(10) ORDER BY k2)) AS d FROM l2 GROUP BY ALL),
l4 AS (SELECT k3 // 64 AS k4, sha256(string_agg(d, chr(10) ORDER BY k3)) AS d FROM l3 GROUP BY ALL),
l5 AS (SELECT sha256(string_agg(d, chr(10) ORDER BY k4)) AS d FROM l4)
SELECT chunk, n_rows, digest, l5.d AS rollup, (SELECT count(*) FROM c) AS n_chunks FROM c, l5""",
    "calendar_integrity": f"""WITH c AS (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY ALL),
a AS (SELECT CAST(d AS DATE) AS d, strftime(d, '%Y-%m-%d') AS name, coalesce(n, 0) AS n, epoch_ns(CAST(d AS TIMESTAMP)) + 5 * {HOUR} AS s, dayofweek(d) NOT IN (0, 6) AND strftime(d, '%Y-%m-%d') <> '2024-01-01' AS is_open
  FROM (SELECT CAST(unnest(generate_series((SELECT CAST(min(ts) AS DATE) FROM events), (SELECT CAST(max(ts) AS DATE) + 1 FROM events), INTERVAL 1 DAY)) AS DATE) AS d) LEFT JOIN c USING (d)),
k AS (SELECT *, s + CASE WHEN n % 7 = 5 THEN 25 ELSE 24 END * {HOUR} AS e FROM a WHERE n % 7 <> 3),
l AS (SELECT *, lead(d) OVER (ORDER BY d) AS d1, lead(s) OVER (ORDER BY d) AS s1 FROM k),
t AS (SELECT name FROM a WHERE is_open AND n % 5 = 1)
SELECT name AS subject, CASE WHEN d1 - d <> 1 THEN 'dates_not_contiguous' ELSE 'days_not_adjacent' END AS rule FROM l WHERE d1 - d <> 1 OR s1 <> e
UNION ALL SELECT 'XNYS:' || name || ':pre', 'instances_overlap' FROM t UNION ALL SELECT 'XNYS:' || name, 'phases' FROM t UNION ALL SELECT 'XNYS:' || name || ':pre', 'id_not_unique' FROM t""",
    "sessions_in_window": f"""WITH {_CALENDAR}, w AS (SELECT 1704985200000000000 - 20 * {HOUR} AS a, 1704985200000000000 + 15 * {HOUR} AS b), m AS (SELECT inst.* FROM inst, w WHERE s < b AND e > a),
d AS (SELECT unnest(generate_series((SELECT CAST(min(ts) AS DATE) FROM events), (SELECT CAST(max(ts) AS DATE) + 1 FROM events), INTERVAL 1 DAY)) AS d)
SELECT session_instance_id AS subject, 'instance' AS kind FROM m
UNION ALL SELECT strftime(d, '%Y-%m-%d'), 'day' FROM d, w WHERE (epoch_ns(CAST(d AS TIMESTAMP)) + 5 * {HOUR} < b AND epoch_ns(CAST(d AS TIMESTAMP)) + 29 * {HOUR} > a) OR strftime(d, '%Y-%m-%d') IN (SELECT trade_date FROM m)""",
    "edge_windows": f"""WITH {_CALENDAR}, p AS (SELECT trade_date, min(s) AS a, max(e) AS b, epoch_ns(CAST(trade_date AS TIMESTAMP)) + 5 * {HOUR} AS d FROM inst GROUP BY trade_date)
SELECT trade_date, 'before' AS edge, d AS "start", a AS "end" FROM p UNION ALL SELECT trade_date, 'after', b, d + {DAY} FROM p""",
    "overnight_bands": f"""WITH {_CALENDAR} SELECT 'XNYS:' || strftime(d, '%Y-%m-%d') || ':over' AS session_instance_id, epoch_ns(CAST(d AS TIMESTAMP)) + 1 * {HOUR} AS "start", epoch_ns(CAST(d AS TIMESTAMP)) + 9 * {HOUR} AS "end" FROM days""",
    "closed_nights": f"""WITH {_CALENDAR}, c AS (SELECT d, epoch_ns(CAST(d AS TIMESTAMP)) + 5 * {HOUR} AS s FROM (SELECT unnest(generate_series((SELECT CAST(min(ts) AS DATE) FROM events), (SELECT CAST(max(ts) AS DATE) + 1 FROM events), INTERVAL 1 DAY)) AS d) WHERE d NOT IN (SELECT d FROM days))
SELECT strftime(d, '%Y-%m-%d') AS trade_date, s AS "start", s + 4 * {HOUR} AS "end" FROM c UNION ALL SELECT strftime(d, '%Y-%m-%d'), s + 20 * {HOUR}, s + 24 * {HOUR} FROM c""",
    "coverage_evidence": f"""WITH {_bars(HOUR)}, ses AS (SELECT c_custkey AS session FROM customer UNION SELECT user_id FROM events WHERE user_id IS NOT NULL),
w AS (SELECT 1704067200000000000 AS base, 7 * {DAY} + {HOUR // 2} AS step),
sp AS (SELECT CAST(floor((min(bar_start) - base) / step) AS BIGINT) AS a, CAST(floor((max(bar_start) + {HOUR} - 1 - base) / step) AS BIGINT) AS b FROM bars, w GROUP BY base, step),
seg AS (SELECT session, base + i * step AS s FROM ses, w, (SELECT unnest(range(a, b + 1)) AS i FROM sp)),
h AS (SELECT symbol, bar_start, CAST(('0x' || substr(md5(symbol || '/' || bar_start || '/' || (bar_start + {HOUR})), 1, 15)) AS BIGINT) AS h FROM bars)
SELECT session, s AS "start", s + 7 * {DAY} AS "end", count(symbol) FILTER (bar_start >= s AND bar_start + {HOUR} <= s + 7 * {DAY}) AS n_rows,
  count(symbol) FILTER (NOT (bar_start >= s AND bar_start + {HOUR} <= s + 7 * {DAY})) AS n_straddling,
  CAST(coalesce(sum(h) FILTER (bar_start >= s AND bar_start + {HOUR} <= s + 7 * {DAY}), 0) AS VARCHAR) AS digest
FROM seg LEFT JOIN h ON symbol = session AND bar_start < s + 7 * {DAY} AND bar_start + {HOUR} > s GROUP BY session, s""",
}
