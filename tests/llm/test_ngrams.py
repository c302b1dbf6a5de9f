"""The trigram model against a plain dictionary model, and its coding."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm.ngrams import DISCOUNT, HOT, EliasFano, class_of, classes_of, hash_of, packed, packed_steps, probability, quantised, score, unpacked, unpacked_steps

END, BEGIN = "<end>", "<begin>"


def tokens(text):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), END]


def plain_model(docs, hot=1):
    """Interpolated absolute discounting with dictionaries; the second level of a hot middle word goes by the class
    of the word before it."""
    train = [tokens(t) for i, t in docs if i is not None and zlib.crc32(str(i).encode()) % 10]
    one = Counter(w for d in train for w in d)
    n, v = sum(one.values()), len(one)
    tri, bi = Counter(), Counter()
    texts = len(train)

    def hinge(a, b):
        n_b = texts if b == BEGIN else one[b]
        own = 0 if a == BEGIN else hash_of(pa.array([a], pa.large_string()))[0]
        return b, int(class_of(np.array([own]), classes_of(np.array([n_b]), n, hot))[0])

    for d in train:
        for a, b, c in zip([BEGIN, BEGIN, *d], [BEGIN, *d], d):
            tri[a, b, c] += 1
            bi[hinge(a, b), c] += 1
    two, three, kinds2, kinds3 = Counter(), Counter(), Counter(), Counter()
    for (b, c), k in bi.items():
        two[b] += k
        kinds2[b] += 1
    for (a, b, c), k in tri.items():
        three[a, b] += k
        kinds3[a, b] += 1

    def p1(w):
        return (one[w] + 0.1) / (n + 0.1 * (v + 1))

    def p(a, b, c):
        low = p1(c)
        h = hinge(a, b)
        if two[h]:
            low = max(bi[h, c] - DISCOUNT, 0) / two[h] + DISCOUNT * kinds2[h] / two[h] * low
        if three[a, b]:
            low = max(tri[a, b, c] - DISCOUNT, 0) / three[a, b] + DISCOUNT * kinds3[a, b] / three[a, b] * low
        return low

    def of(text):
        d = tokens(text)
        return len(d), sum(one[w] > 0 for w in d), sum(math.log10(p1(w)) for w in d), sum(math.log10(p(a, b, c)) for a, b, c in zip([BEGIN, BEGIN, *d], [BEGIN, *d], d))

    return of, n


def test_coding():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (5, 3), (1000, 100), (1000, 10**12)):
        values = np.sort(rng.integers(0, top, n))
        assert (EliasFano(values).values() == values).all()
        assert (unpacked(packed(values)) == values).all()
        shuffled = rng.permutation(values)
        assert (unpacked_steps(packed_steps(shuffled)) == shuffled).all()
    p = np.array([0.0, 1.0, 0.5, 1e-9])
    assert np.allclose(probability(quantised(p)), p, rtol=1e-3)


def test_search_on_the_coded_sequence():
    rng = np.random.default_rng(3)
    for n, top in ((1, 1), (7, 3), (500, 40), (2000, 10**6), (3000, 10**15)):
        values = np.sort(rng.integers(0, top, n))
        coded = EliasFano(values)
        wanted = np.concatenate([rng.choice(values, 200), rng.integers(0, top + 5, 200)])
        begin = rng.integers(0, n + 1, 400)
        end = np.minimum(begin + rng.integers(0, n + 1, 400), n)
        at, equal = coded.successor(wanted, begin, end)
        for w, a, b, got, same in zip(wanted, begin, end, at, equal):
            want = a + int(np.searchsorted(values[a:b], w))
            assert got == want and same == (want < b and values[want] == w)
    at, equal = EliasFano(np.zeros(0, dtype=np.int64)).successor(np.array([3]), 0, 0)
    assert at.tolist() == [0] and equal.tolist() == [False]


@pytest.mark.parametrize("hot", [1, HOT])
@pytest.mark.parametrize("block_tokens", [300, 10**6])
def test_scores_equal_the_plain_model(spark, block_tokens, hot):
    rng = random.Random(4)
    words = [f"w{int(rng.paretovariate(0.8))}" for _ in range(300)] + ["The", "Ünï", "a\x1cb"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    docs += [(1000, None), (1001, ""), (1002, "never seen words here"), (1003, docs[5][1]), (None, "the the"), (7, "repeated id"), (1004, "x " * 5000)]
    frame = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, score string")
    of, n = plain_model(docs, hot)
    got = sorted(score(frame, hot=hot, block_tokens=block_tokens).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens))
    assert len(got) == len(docs)
    for r, (i, t) in zip(got, sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, len(tokens(d[1]))))):
        length, known, base, whole = of(t)
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens) == (i, length, known, n)
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 10 == 0)
        assert r.base_score == pytest.approx(base, abs=1e-6) and r.score == pytest.approx(whole, rel=2e-3, abs=1e-2)


def test_no_documents(spark):
    assert score(spark.createDataFrame([], "doc_id long, text string")).collect() == []
