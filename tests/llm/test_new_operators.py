"""Quality by naive Bayes support vectors, fill-in-the-middle, importance resampling: against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm import nb_svm, resample
from tickloom.llm.fim import boundaries, fill_in_middle, restored, select
from tickloom.llm.queries import op12_fill_in_middle, op13_importance_resampling

DOCS = "doc_id long, text string"
TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")
ODD = ["", None, "a", "1", "ab cd", "é", "aéb", "żółć x", "😀😀", "a\nb\r\n", "\x00a", "x<P>y", "<S>", "q<M", " zz İ", "word " * 5000, "<" * 9 + "P>"]


def plain_fim(doc_id, text):
    text = text or ""
    hx = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hx[i : i + 8], 16) for i in (0, 8, 16, 24))
    tokens = TOKEN.findall(text)
    n = len(tokens)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:low]), "".join(tokens[low:high]), "".join(tokens[high:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_boundaries_and_ranks_of_bits():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("ab Z1é😀\n-") for _ in range(rng.randint(0, 40)))
        data, ends = text.encode(), []
        for token in TOKEN.finditer(text):
            ends.append(len(text[: token.start()].encode()))
        starts, leads = boundaries(data)
        assert [i for i in range(len(data)) if starts >> i & 1] == ends and leads.bit_count() == len(text)
        assert [select(starts, k, len(data)) for k in range(len(ends) + 2)] == [*ends, len(data), len(data)]


def test_fill_in_middle_against_plain_python(spark):
    rng = random.Random(5)
    rows = list(enumerate(ODD)) + [(100 + i, "".join(rng.choice(["word", " ", "é", "42", "\n", "<P", ">"]) for _ in range(rng.randint(1, 60)))) for i in range(400)]
    rows += [(None, "no id"), (None, "no id"), (7, "same id twice"), (7, "same id twice")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("fim", F.lit("clash")).withColumn("_fim", F.lit(1))
    made = fill_in_middle(docs)
    assert made.columns == [*docs.columns, "__fim"]
    back = made.select("doc_id", "text", "fim", "__fim.*", restored(F.col("__fim.text"), F.col("__fim.form")).alias("back")).toPandas()
    assert set(back["fim"]) == {"clash"}
    got = Counter((None if math.isnan(i) else int(i), int(n), form, None if math.isnan(p) else int(p), None if math.isnan(m) else int(m), o) for i, n, form, p, m, o in zip(back["doc_id"], back["n"], back["form"], back["prefix_chars"], back["middle_chars"], back.iloc[:, 7]))
    assert got == Counter((i, *plain_fim(i, t)) for i, t in rows)
    assert Counter(back["back"]) == Counter(t or "" for _, t in rows)
    assert {"plain", "psm", "spm"} == set(back["form"])
    assert fill_in_middle(spark.createDataFrame([], DOCS)).collect() == []


def test_fill_in_middle_query_over_a_table(spark, sf):
    got = {r.doc_id: r for r in op12_fill_in_middle(spark, sf).collect()}
    for doc_id, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        n, form, prefix, middle, out = plain_fim(doc_id, text)
        assert (got[doc_id].n, got[doc_id].form, got[doc_id].prefix_chars, got[doc_id].middle_chars) == (n, form, prefix, middle)
        assert got[doc_id].output_sha256 == hashlib.sha256(out.encode()).hexdigest()
        assert got[doc_id].restored_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain_resample(rows, target, percent=25, least_words=20):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, plain_features(text)[1]))
    for text in target:
        t.update(map(bucket, plain_features(text)[1]))
    s_all, t_all = sum(s.values()), sum(t.values())
    out, pool = [], []
    for i, text in rows:
        words, features = plain_features(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in map(bucket, features)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(features), weight, score, None])
        if len(words) >= least_words:
            pool.append(out[-1])
    pool.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(pool[: percent * len(pool) // 100]):
        r[4] = k + 1
    return Counter(map(tuple, out))


def test_resampling_against_plain_python(spark):
    rng = random.Random(8)
    vocabulary = ["alpha", "Beta", "GAMMA", "é", "naïve", "x1", "42", "ﬁ", "日本"]
    rows = list(enumerate(ODD)) + [(50 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 5, 19, 20, 21, 80])))) for i in range(300)]
    rows += [(None, "alpha beta " * 15)] * 3 + [(60, "same id, other text " * 9), (61, rows[60][1]), (61, rows[60][1])]
    target = [(0, "alpha beta gamma alpha beta"), (1, None), (2, "42 日本")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("clash") for c in ("id", "weight", "score", "rank", "_in", "_at", "n_features", "_place")})
    benchmark = spark.createDataFrame(target, "item_id long, text string")
    got = resample.resample(docs.repartition(7), benchmark)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == plain_resample(rows, [t for _, t in target])
    # all rows with nothing in the target, and no rows at all
    assert Counter(map(tuple, resample.resample(docs, benchmark.limit(0), percent=100, least_words=0).collect())) == plain_resample(rows, [], 100, 0)
    assert resample.resample(docs.limit(0), benchmark).collect() == []
    kept = resample.drawn(docs, benchmark)
    ranks = plain_resample(rows, [t for _, t in target])
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter({i: n for i, n in Counter(k[0] for k in ranks.elements() if k[4]).items()})
    assert resample.drawn(docs.limit(0), benchmark).collect() == []


def test_resampling_query_over_a_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert Counter(map(tuple, op13_importance_resampling(spark, sf).collect())) == plain_resample(rows, target)


def test_streams_do_not_depend_on_the_pieces_they_are_read_in():
    rng = random.Random(2)
    for _ in range(100):
        data = "".join(rng.choice(["ab", " ", ".", "é", "Z9 "]) for _ in range(rng.randint(0, 50))).encode()
        want = Counter(zlib.crc32(f.encode()) % 997 for f in plain_features(data.decode())[1])
        for piece in (1, 3, 1000):
            assert Counter(resample.bucket_stream(data, 997, piece).tolist()) == want
    with pytest.raises(ValueError):
        resample.streams(None, "a", "b", 1 << 17)


def toy_rows(n=120, dim=30, seed=4):
    rng = np.random.default_rng(seed)
    lists = [np.flatnonzero(rng.random(dim) < (0.35 if i % 3 else 0.2)).astype(np.int32) for i in range(n)]
    positive = np.array([bool(i % 3) ^ (rng.random() < 0.1) for i in range(n)])
    return (np.concatenate([[0], np.cumsum([len(x) for x in lists])]), np.concatenate(lists)), positive


def test_log_count_ratios_against_plain_python():
    x, positive = toy_rows()
    counts = {True: Counter(), False: Counter()}
    for i, y in enumerate(positive):
        counts[bool(y)].update(x[1][x[0][i] : x[0][i + 1]].tolist())
    total = {y: sum(c.values()) + 30 for y, c in counts.items()}
    want = [math.log((counts[True][k] + 1) / total[True] / ((counts[False][k] + 1) / total[False])) for k in range(30)]
    assert nb_svm.log_count_ratios(x, positive, 30) == pytest.approx(want)


def test_dual_descent_closes_the_gap_to_the_primal():
    x, positive = toy_rows()
    rows = nb_svm.scaled(x, nb_svm.log_count_ratios(x, positive, 30))
    sign, cost = np.where(positive, 1.0, -1.0), np.where(positive, 1.0, 2.5)
    w, alpha = nb_svm.dual_descent(rows, sign, 30, cost, rounds=3000, tolerance=1e-9)
    dense = np.zeros((len(sign), 31))
    for i in range(len(sign)):
        dense[i, rows[1][rows[0][i] : rows[0][i + 1]]] = rows[2][rows[0][i] : rows[0][i + 1]]
    dense[:, 30] = 1.0
    assert np.linalg.norm(dense[:, :30], axis=1) == pytest.approx(np.ones(len(sign)))
    assert w == pytest.approx((alpha * sign) @ dense) and (alpha >= 0).all() and (alpha <= cost).all()
    primal = w @ w / 2 + (cost * np.maximum(0, 1 - sign * (dense @ w))).sum()
    dual = alpha.sum() - w @ w / 2
    assert primal == pytest.approx(dual, rel=1e-5)
    # no nearby weights do better
    rng = np.random.default_rng(0)
    for _ in range(200):
        other = w + rng.normal(size=31) * 0.05
        assert other @ other / 2 + (cost * np.maximum(0, 1 - sign * (dense @ other))).sum() >= primal - 1e-6


def test_indicators_are_the_distinct_grams_of_each_text():
    texts = pa.array(["ab ab ab c", None, "", "x", "ab c ab c", "word " * 300])
    indptr, index = nb_svm.indicators(texts)
    rows = [index[a:b].tolist() for a, b in zip(indptr[:-1], indptr[1:])]
    assert all(len(r) == len(set(r)) for r in rows) and rows[1] == rows[2] == []
    runs = [sorted(g - nb_svm.RUNS for g in r if g >= nb_svm.RUNS) for r in rows]
    assert runs == [[0, 1], [], [], [], [], [0, 1, 2, 3]]
    for text, r in zip(texts.to_pylist(), rows):
        data = (text or "").encode()
        assert sum(g < 1 << nb_svm.CHAR_BITS for g in r) == len({data[i : i + n] for n in nb_svm.CHARS for i in range(len(data) - n + 1)})
    alone = [nb_svm.indicators(texts.slice(i, 1))[1].tolist() for i in range(len(texts))]
    assert alone == rows


def labelled(n=900, seed=6):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = ["".join(rng.choice("aeiourstn") for _ in range(rng.randint(2, 8))) for _ in range(rng.choice([4, 30, 200]))]
        text = " ".join(words) if good else " ".join(w + rng.choice(["$$$", "###", "%%"]) for w in words) if i % 2 else " ".join(words[:1] * 40)
        rows.append((i, text))
        if i % 4:
            labels.append((i, int(good)))
    return rows, labels


def test_classifier_on_rows_it_did_not_see(spark):
    rows, labels = labelled()
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("clash") for c in ("_id", "_text", "_y", "score", "held_out", "grams", "_order")})
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r for r in nb_svm.classify(docs, known).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    held = [(got[i].predicted, q) for i, q in labels if got[i].held_out]
    assert {i for i in got if got[i].held_out} == {i for i in got if zlib.crc32(str(i).encode()) % 4 == 2}
    assert len(held) > 100 and sum(a == b for a, b in held) >= 0.98 * len(held)
    # held-out labels change nothing
    turned = spark.createDataFrame([(i, 1 - q if got[i].held_out else q) for i, q in labels], "doc_id long, quality int")
    assert {r.doc_id: r.score for r in nb_svm.classify(docs, turned).collect()} == {i: r.score for i, r in got.items()}


def test_classifier_without_classes_ids_or_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "abc"), (3, "abc"), (3, "abd"), (4, "long " * 50_000)], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(3, 1), (3, None), (None, 0)], "doc_id long, quality int")
    both = spark.createDataFrame([(1, 0), (3, 1), (4, 1), (2, 0)], "doc_id long, quality int")
    for labels in (none, one):
        assert [r.score for r in nb_svm.classify(docs, labels).collect()] == [0.5] * 6
    scores = [r.score for r in nb_svm.classify(docs, both).collect()]
    assert scores[0] == scores[1] and scores[2] == scores[3] and all(0 <= s <= 1 for s in scores)
    assert nb_svm.classify(docs.limit(0), both).collect() == []
