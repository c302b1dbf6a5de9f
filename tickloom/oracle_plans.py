"""SQL of the queries over tables of requests."""

from __future__ import annotations

from tickloom.oracle import _MAP, DAY, HOUR, normalized_from
from tickloom.queries_plans import CAPABILITIES, FIRST, HOLIDAYS, LAST, SHIFT

MINUTE = HOUR // 60


def _value(v: object) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v).lower()


_CAPS = ", ".join(f"({', '.join(map(_value, row))})" for row in CAPABILITIES)
_PLANS = f"""days AS (SELECT strftime(d, '%Y-%m-%d') AS trade_date, epoch_ns(CAST(d AS TIMESTAMP)) + 5 * {HOUR} AS s, epoch_ns(CAST(d AS TIMESTAMP)) + 29 * {HOUR} AS e,
    dayofweek(d) NOT IN (0, 6) AND strftime(d, '%Y-%m-%d') NOT IN {HOLIDAYS} AS is_open FROM (SELECT unnest(generate_series(DATE '{FIRST}', DATE '{LAST}', INTERVAL 1 DAY)) AS d)),
inst AS (SELECT *, row_number() OVER (ORDER BY s, trade_date, phase) AS pos FROM (
    SELECT trade_date, phase, s + a * {HOUR // 2} AS s, s + b * {HOUR // 2} AS e FROM days, (VALUES ('pre', 8, 19), ('regular', 19, 32), ('after', 32, 40), ('over', -8, 8)) t(phase, a, b)
    WHERE is_open AND CASE phase WHEN 'over' THEN CAST(right(trade_date, 2) AS INTEGER) % 3 = 0 ELSE trade_date NOT LIKE '%-13' END)),
q0 AS (SELECT o_orderkey AS id, o_orderkey AS k, epoch_ns(o_orderdate) + {SHIFT} * {DAY} + o_orderkey % 24 * {HOUR} + o_orderkey % 7 * {MINUTE} AS s FROM orders),
q AS (SELECT id, s, s + (k * 7 % 90 + 1) * {HOUR} AS e, greatest(least(s + (k % 11 * 9 - 20) * {HOUR}, 1564635599999999999), 1359694800000000000) AS now, ['1m', '1m', '1h', '1d', '1m'][k % 5 + 1] AS res,
    ['all', 'regular', 'extended', 'overnight'][k % 4 + 1] AS scope, ['auto', 'auto', 'alpaca_only', 'futu_only', 'research', 'auto'][k // 4 % 6 + 1] AS mode, k % 3 = 0 AS down FROM q0),
q1 AS (SELECT *, res <> '1d' AND (mode = 'research' OR s < 1451624400000000000) AS early, (SELECT min(s) FROM days) AS ca, (SELECT max(e) FROM days) AS cb FROM q),
q2 AS (SELECT *, CASE WHEN early AND down THEN '1d' ELSE res END AS iv, early AND NOT down AS cut, greatest(s, ca) AS cs, least(e, cb) AS ce FROM q1),
q3 AS (SELECT *, CASE WHEN mode = 'research' THEN ce ELSE least(ce, 1451624400000000000) END AS uns FROM q2),
work AS (SELECT id, CASE WHEN cut THEN greatest(cs, uns) ELSE cs END AS s, ce AS e, now, iv, mode, scope FROM q3 WHERE CASE WHEN cut THEN greatest(cs, uns) ELSE cs END < ce),
clock AS (SELECT now, max(pos) FILTER (now < e) AS opened, max(pos) FILTER (e <= now) AS done FROM (SELECT DISTINCT now FROM work) LEFT JOIN inst ON s <= now GROUP BY now),
w AS (SELECT * FROM work JOIN clock USING (now)),
edge0 AS (SELECT d.trade_date, d.s, d.e, CASE WHEN i.s IS NOT NULL THEN greatest(i.s, d.s) END AS a, CASE WHEN i.s IS NOT NULL THEN least(i.e, d.e) END AS b FROM days d LEFT JOIN inst i ON i.s < d.e AND d.s < i.e WHERE is_open),
edge1 AS (SELECT trade_date, coalesce(max(b) OVER (PARTITION BY trade_date ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), s) AS a, coalesce(a, e) AS b FROM edge0
    UNION ALL SELECT trade_date, max(b), max(e) FROM edge0 WHERE b IS NOT NULL GROUP BY trade_date),
bounds AS (SELECT trade_date, min(s) AS f, max(e) AS l FROM inst GROUP BY trade_date),
raw AS (
    SELECT w.*, i.trade_date, i.phase, i.pos, greatest(w.s, i.s) AS a, least(w.e, i.e) AS b, i.s <= now AND now < i.e AS active, NULL AS missing FROM w JOIN inst i ON i.s < w.e AND w.s < i.e WHERE iv <> '1d'
      AND (scope = 'all' OR (scope = 'regular' AND phase = 'regular') OR (scope = 'extended' AND phase IN ('pre', 'after')) OR (scope = 'overnight' AND phase = 'over'))
    UNION ALL SELECT w.*, x.trade_date, NULL, NULL, greatest(w.s, x.a), least(w.e, x.b), false, 'missing_calendar_phase' FROM w JOIN edge1 x ON x.a < x.b AND x.a < w.e AND w.s < x.b LEFT JOIN bounds USING (trade_date) WHERE iv <> '1d'
      AND (scope = 'all' OR (scope = 'overnight' AND (least(w.e, x.b) <= f OR greatest(w.s, x.a) >= l)))
    UNION ALL SELECT w.*, d.trade_date, NULL, max(i.pos) FILTER (i.s <= now), greatest(w.s, d.s), least(w.e, d.e), coalesce(arg_max(now < i.e, i.pos) FILTER (i.s <= now), false), CASE WHEN count(i.pos) = 0 THEN 'missing_calendar_phase' END
      FROM w JOIN days d ON is_open AND d.s < w.e AND w.s < d.e LEFT JOIN inst i ON i.trade_date = d.trade_date WHERE iv = '1d' GROUP BY ALL),
ranked AS (SELECT *, CASE WHEN opened IS NOT NULL THEN CASE WHEN pos = opened THEN 'new' WHEN pos = opened - 1 THEN 'buffer' WHEN pos < opened THEN 'old' END WHEN pos = done THEN 'buffer' WHEN pos < done THEN 'old' END AS rank FROM raw),
gap0 AS (SELECT *, CASE WHEN missing IS NOT NULL THEN missing WHEN rank IS NULL THEN 'future_session' WHEN iv = '1d' AND trade_date < '2016-01-01' AND mode IN ('alpaca_only', 'futu_only') THEN 'source_mode_excludes_required_provider' END AS g FROM ranked),
prov AS (SELECT *, CASE WHEN g IS NOT NULL THEN NULL WHEN mode = 'research' OR (iv = '1d' AND trade_date < '2016-01-01') THEN 'yfinance' WHEN mode = 'futu_only' OR (mode = 'auto' AND rank <> 'old') THEN 'futu' ELSE 'alpaca' END AS p FROM gap0),
fed AS (SELECT *, CASE p WHEN 'yfinance' THEN 'daily' WHEN 'alpaca' THEN CASE WHEN phase = 'over' THEN 'boats' ELSE 'sip' END END AS f FROM prov),
caps(cp, cf, cph, civ, h, r, prio) AS (VALUES {_CAPS}),
cap AS (SELECT *, coalesce(h, false) AS hh, active AND a <= now AND now < b AND coalesce(r, false) AS live FROM fed LEFT JOIN caps ON p = cp AND f IS NOT DISTINCT FROM cf AND phase IS NOT DISTINCT FROM cph AND iv = civ),
done AS (SELECT *, CASE WHEN g IS NOT NULL THEN g WHEN NOT hh AND NOT live THEN 'missing_provider_capability' END AS g1 FROM cap),
sl AS (SELECT id AS request_id, trade_date, phase, 'XNYS:' || (SELECT x.trade_date || ':' || x.phase FROM inst x WHERE x.pos = done.pos) AS instance, a, b, iv, scope, rank, hh AS historical, g1 IS NULL AND live AS realtime,
    coalesce((opened IS NULL AND rank = 'buffer' AND p = 'futu') OR (iv = '1d' AND rank = 'new' AND p = 'futu' AND active), false) AS provisional,
    CASE WHEN iv = '1d' AND scope IN ('extended', 'overnight') THEN NULL ELSE p END AS provider, CASE WHEN iv = '1d' AND scope IN ('extended', 'overnight') THEN NULL ELSE f END AS feed,
    CASE WHEN iv = '1d' AND scope IN ('extended', 'overnight') THEN 'unsupported_resolution' ELSE g1 END AS gap FROM done),
ok AS (SELECT * FROM sl WHERE gap IS NULL)"""
_NIGHTS = f"""band AS (SELECT id, greatest(q2.s, n.a) AS a, least(q2.e, n.b) AS b FROM q2 JOIN (SELECT s AS a, s + 4 * {HOUR} AS b FROM days WHERE NOT is_open UNION ALL SELECT e - 4 * {HOUR}, e FROM days WHERE NOT is_open) n ON n.a < q2.e AND q2.s < n.b
    WHERE iv <> '1d' AND scope IN ('all', 'overnight')),
cover AS (SELECT band.*, CASE WHEN o.a IS NOT NULL THEN greatest(o.a, band.a) END AS x, CASE WHEN o.a IS NOT NULL THEN least(o.b, band.b) END AS y FROM band LEFT JOIN sl o ON o.request_id = band.id AND o.phase = 'over' AND o.a < band.b AND band.a < o.b),
dark AS (SELECT id, coalesce(max(y) OVER (PARTITION BY id, a, b ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a) AS s, coalesce(x, b) AS e FROM cover UNION ALL SELECT id, max(y), max(b) FROM cover WHERE y IS NOT NULL GROUP BY id, a, b)"""
_PLAN_GAPS = f"""{_NIGHTS}, gaps AS (
    SELECT id AS key, s, least(e, ca) AS e, 'unknown' AS reason FROM q3 WHERE s < least(e, ca) UNION ALL SELECT id, greatest(s, cb), e, 'unknown' FROM q3 WHERE greatest(s, cb) < e
    UNION ALL SELECT id, cs, uns, 'unsupported_resolution' FROM q3 WHERE cut AND cs < uns UNION ALL SELECT id, s, e, 'unknown' FROM dark WHERE s < e
    UNION ALL SELECT request_id, a, b, CASE gap WHEN 'missing_provider_capability' THEN 'provider_unavailable' WHEN 'unsupported_resolution' THEN gap ELSE 'unknown' END FROM sl WHERE gap IS NOT NULL)"""

_PAGES = f"""turn AS (SELECT *, CASE WHEN lag(provider) OVER w IS DISTINCT FROM provider OR lag(feed) OVER w IS DISTINCT FROM feed THEN 1 ELSE 0 END AS new FROM ok WINDOW w AS (PARTITION BY request_id ORDER BY a DESC)),
ranged AS (SELECT *, CAST(sum(new) OVER (PARTITION BY request_id ORDER BY a DESC) AS BIGINT) AS run FROM turn),
runs1 AS (SELECT DISTINCT request_id, run, provider, iv FROM ranged),
row0 AS (SELECT id AS request_id, CAST(l_linenumber AS BIGINT) % 3 + 1 AS run, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id, l_partkey AS n, l_suppkey % 10 % 5 AS kind, q.s AS qs, q.e AS qe,
    q.s + (l_partkey * 37 + l_linenumber * 11) % ((q.e - q.s) // {MINUTE}) * {MINUTE} AS s FROM lineitem JOIN q ON l_orderkey = id),
row1 AS (SELECT r.*, s + CASE WHEN n % 19 = 0 THEN 90 ELSE 1 END * {MINUTE} AS e FROM row0 r JOIN runs1 USING (request_id, run)),
row2 AS (SELECT r.*, count(x.a) FILTER (x.a <= s AND e <= x.b) AS n_in, min(instance) FILTER (x.a <= s AND e <= x.b) AS instance, bool_or(provisional) FILTER (x.a <= s AND e <= x.b) AS prov
    FROM row1 r LEFT JOIN ranged x ON x.request_id = r.request_id AND x.run = r.run AND x.a < e AND s < x.b GROUP BY ALL),
row3 AS (SELECT *, CASE WHEN n % 17 = 0 THEN 'unknown' WHEN kind = 3 THEN 'validation_conflict' WHEN kind = 4 THEN 'entitlement_limited' WHEN n % 29 = 0 OR n % 23 = 0 THEN 'validation_conflict' WHEN e > qe OR n_in <> 1 OR instance IS NULL THEN 'unknown' END AS reason FROM row2),
row4 AS (SELECT *, reason IS NULL AND (coalesce(max(e) FILTER (reason IS NULL) OVER (PARTITION BY request_id, run, reason IS NULL ORDER BY s, e, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), s) > s
    OR coalesce(lead(s) OVER (PARTITION BY request_id, run, reason IS NULL ORDER BY s, e, row_id), e) < e) AS clash FROM row3)"""

_ANSWERS = f"""{_PAGES}, blocked AS (SELECT key AS request_id, s AS x, e AS y FROM gaps UNION ALL
    SELECT r.request_id, greatest(s, a), least(e, b) FROM row4 r JOIN ranged x ON x.request_id = r.request_id AND x.run = r.run AND x.a < e AND s < x.b WHERE clash OR reason IS NOT NULL),
answer AS (SELECT r.*, CASE kind WHEN 0 THEN provider WHEN 1 THEN upper(provider) ELSE 'unknown' END AS source, CASE kind WHEN 1 THEN 'delayed' ELSE 'authorized' END AS entitlement, prov OR kind IN (1, 2) OR n % 7 = 0 OR request_id % 10 = 0 AS unsure
    FROM row4 r JOIN runs1 USING (request_id, run) WHERE reason IS NULL AND NOT clash AND NOT EXISTS (SELECT 1 FROM blocked k WHERE k.request_id = r.request_id AND k.x < r.e AND r.s < k.y))"""

ORACLES = {
    "page_sources": f"""WITH {_PLANS}, {_PAGES} SELECT DISTINCT request_id, run, 'p' || kind AS provenance_id, CASE kind WHEN 0 THEN provider WHEN 1 THEN upper(provider) ELSE 'unknown' END AS provider,
CASE kind WHEN 1 THEN 'delayed' ELSE 'authorized' END AS entitlement FROM row3 JOIN runs1 USING (request_id, run) WHERE reason IS NULL""",
    "answer_rows": f"""WITH {_PLANS}, {_PLAN_GAPS}, {_ANSWERS} SELECT request_id, run, row_id, s AS "start", e AS "end", CASE WHEN unsure THEN 'provisional' ELSE 'validated' END AS validation_state FROM answer""",
    "answer_summaries": f"""WITH {_PLANS}, {_PLAN_GAPS}, {_ANSWERS}, label AS (SELECT request_id, count(*) AS n, bool_or(unsure) AS unsure, count(DISTINCT source) AS ns, min(source) AS s1, count(DISTINCT entitlement) AS ne, min(entitlement) AS e1 FROM answer GROUP BY ALL)
SELECT request_id, coalesce(n, 0) AS n_rows, coalesce(unsure, false) AS provisional, CASE WHEN n IS NULL THEN 'unknown' WHEN ns = 1 THEN s1 ELSE 'mixed' END AS source, CASE WHEN n IS NULL THEN 'unknown' WHEN ne = 1 THEN e1 ELSE 'mixed' END AS entitlement
FROM (SELECT DISTINCT request_id FROM runs1) LEFT JOIN label USING (request_id)""",
    "page_rows": f"""WITH {_PLANS}, {_PAGES} SELECT request_id, run, row_id, s AS "start", e AS "end", instance AS session_instance_id,
CASE WHEN prov OR kind IN (1, 2) OR n % 7 = 0 OR request_id % 10 = 0 THEN 'provisional' ELSE 'validated' END AS validation_state FROM row4 WHERE reason IS NULL AND NOT clash""",
    "page_gaps": f"""WITH {_PLANS}, {_PAGES}, gaps AS (SELECT r.request_id * 1000 + r.run AS key, greatest(s, a) AS s, least(e, b) AS e, CASE WHEN clash THEN 'validation_conflict' ELSE reason END AS reason
    FROM row4 r JOIN ranged x ON x.request_id = r.request_id AND x.run = r.run AND x.a < e AND s < x.b WHERE clash OR reason IS NOT NULL), {normalized_from(_MAP, "key // 1000 AS request_id, key % 1000 AS run")}""",
    "request_slices": f'WITH {_PLANS} SELECT request_id, trade_date, phase, a AS "start", b AS "end", iv AS interval, rank, provider, feed, gap, historical, realtime, provisional FROM sl',
    "request_gaps": f"WITH {_PLANS}, {_PLAN_GAPS}, {normalized_from(_MAP, "key AS request_id")}",
    "request_groups": f"""WITH {_PLANS}, g AS (SELECT request_id, provider, feed, iv AS interval, min(a) AS s, max(b) AS e, count(*) AS n_slices FROM ok GROUP BY ALL)
SELECT request_id, provider, feed, interval, s AS "start", e AS "end", n_slices, row_number() OVER (PARTITION BY request_id ORDER BY e DESC, provider, feed NULLS FIRST) AS position FROM g""",
    "request_runs": f"""WITH {_PLANS}, k AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY a DESC) - row_number() OVER (PARTITION BY request_id, provider, feed ORDER BY a DESC) AS n FROM ok),
r AS (SELECT request_id, provider, feed, iv AS interval, min(a) AS oldest_start, max(a) AS newest_start, count(*) AS n_slices FROM k GROUP BY request_id, provider, feed, iv, n)
SELECT request_id, row_number() OVER (PARTITION BY request_id ORDER BY newest_start DESC) AS run, provider, feed, interval, oldest_start, newest_start, n_slices FROM r""",
}
