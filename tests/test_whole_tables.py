"""Queries without SQL read whole tables: brute force."""

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from tickloom.functions.time import DAY, HOUR
from tickloom.functions.values import row_hash
from tickloom.queries import WITHOUT_SQL, _bars

BASE, STEP = 1_704_067_200 * 10**9, 7 * DAY + HOUR // 2


def test_every_user_has_evidence_with_a_digest(spark, tmp_path):
    users = [5, 199, 200, 250, 7000]
    rows = [(i, f"2024-01-{1 + i * 7 % 31:02d} {i % 24:02d}:10:00", u, "purchase", 1.0 + i, '{"k": 3}') for i, u in enumerate(users * 40)]
    spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(0, 260).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    want, at_least_one, bars = defaultdict(lambda: [0, 0, 0]), set(), 0
    made = _bars(spark, str(tmp_path)).select(F.col("symbol").alias("session"), F.col("bar_start").alias("start"), (F.col("bar_start") + HOUR).alias("end"), "open", "high", "low", "close", "volume", "trade_count")
    for r in made.withColumn("h", row_hash([F.col(c) for c in made.columns])).collect():
        bars += 1
        for i in range(-1, 6):
            s = BASE + i * STEP
            if r.start < s + 7 * DAY and s < r.end:
                inside = s <= r.start and r.end <= s + 7 * DAY
                of = want[r.session, s]
                of[0 if inside else 1] += 1
                of[2] += r.h if inside else 0
                at_least_one.add((r.session, r.start))
    got = {(r.session, r.start): [r.n_rows, r.n_straddling, int(r.digest)] for r in WITHOUT_SQL["coverage_evidence_all"](spark, str(tmp_path)).collect()}
    assert len(at_least_one) == bars > 0
    assert {k: v for k, v in got.items() if v[0] or v[1]} == want
    assert {k[0] for k in got} == set(range(260)) | {7000} and {k[1] for k in got} == {BASE + i * STEP for i in range(5)}


def test_chunks_digest_all_lines_in_order(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    ns = lines.withColumn("l_shipdate", (F.unix_micros(F.col("l_shipdate").cast("timestamp")) * 1000))
    order = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    chunks, sha = defaultdict(list), lambda text: hashlib.sha256(text.encode()).hexdigest()
    for r in ns.select(*order, F.to_json(F.struct(*ns.columns)).alias("j")).collect():
        chunks[r.l_orderkey // 1000].append((*[r[c] for c in order], sha(r.j)))
    want = {c: (len(chunks[c]), sha("\n".join(x[-1] for x in sorted(chunks[c])))) for c in sorted(chunks)}
    tree = {c: w[1] for c, w in want.items()}
    for _ in range(3):
        tree = {n: sha("\n".join(tree[c] for c in sorted(tree) if c // 1024 == n)) for n in {c // 1024 for c in tree}}
    (fold,) = tree.values()
    got = WITHOUT_SQL["chunk_rollup_all"](spark, sf).collect()
    assert {r.chunk: (r.n_rows, r.digest) for r in got} == want
    assert sum(r.n_rows for r in got) == lines.count() and {(r.rollup, r.n_chunks) for r in got} == {(fold, len(want))}
