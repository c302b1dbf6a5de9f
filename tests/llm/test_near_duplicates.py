"""SimHash and embedding near-dedup against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tickloom.llm.blocks import Forest
from tickloom.llm.components import connected_components
from tickloom.llm.embeddings import Caps, fit_caps, most_differing, near_vectors, units
from tickloom.llm.simhash import covering_masks, near_duplicates


def print_of(text):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    out = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return out - (1 << 64) if out >> 63 else out


def groups(n, linked):
    forest = Forest(n)
    for a in range(n):
        for b in range(a):
            if linked(a, b):
                forest.link(a, b)
    return [forest.find(i) for i in range(n)]


def test_masks_cover_every_pair_within_the_radius():
    masks = covering_masks(3)
    rng = random.Random(5)
    assert len(masks) == 15
    for _ in range(3000):
        difference = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any((m & difference) == 0 for m in masks)


def test_simhash_equals_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünï", "IDIOT", "a\x1cb"]
    texts = [None, "", " \t\n", "one", "One", "two words", "x " * 30000]
    for _ in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    rows = [(i, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")  # a clashing name
    prints = [print_of(t) for t in texts]
    want = groups(len(rows), lambda a, b: bin((prints[a] ^ prints[b]) & (2**64 - 1)).count("1") <= 3)
    got = {r.doc_id: (r.fp, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == {i: (prints[i], want[i]) for i in range(len(rows))}


def test_simhash_of_null_ids_repeats_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "a b c"), (None, "alone here now")], "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id) for r in near_duplicates(docs).collect())
    assert got == Counter({(None, 4): 1, (4, 4): 2, (None, None): 1})
    assert near_duplicates(docs.limit(0)).collect() == []


def test_a_large_group_is_cut_into_pieces(spark):
    from tickloom.llm.simhash import links

    fps = [sum(1 << b for b in c) for c in [(i, j) for i in range(40) for j in range(i)]]
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = links(frame, 3, block=64)
    assert edges.count() < 40 * len(fps)
    roots = {r.node: r.root for r in connected_components(edges).collect()}
    assert set(roots) == set(fps) and set(roots.values()) == {min(fps)}


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(1000 + i, 7) for i in range(50)]
    edges = spark.createDataFrame(path + star + [(5, 5)], "u long, v long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{1000 + i: 7 for i in range(50)}, 7: 7}


@pytest.mark.parametrize("chain", [4096, 50])
def test_vectors_equal_brute_force(spark, chain):
    rng = np.random.default_rng(2)
    rows, n = [], 0
    for _ in range(40):
        centre = rng.standard_normal(16)
        for _ in range(int(rng.integers(1, 9))):
            rows.append((n, [float(x) for x in np.float32(centre + 0.12 * rng.standard_normal(16))]))
            n += 1
    hot = rng.standard_normal(16)
    for _ in range(300):  # a group of near copies far above the block size
        rows.append((n, [float(x) for x in np.float32(hot + 0.05 * rng.standard_normal(16))]))
        n += 1
    rows += [(n + i, [float(x) for x in np.float32(hot)]) for i in range(30)]
    n += 30
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    rows += [(n + i, v) for i, v in enumerate(bad)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), block=64, chain=chain).collect()}
    x = np.array([v for i, v in rows[:n]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    want = groups(n, lambda a, b: near[a, b])
    found = sum(got[i][0] for i in range(n))
    assert found <= near.sum() and found >= 0.97 * near.sum()
    assert sum(got[i][1] == want[i] for i in range(n)) >= 0.98 * n
    assert all(got[i][2] == (got[i][1] == i) for i in range(n))
    assert all(got[n + i] == (0, n + i, True) for i in range(len(bad)))


def test_links_do_not_depend_on_how_large_a_group_is(spark):
    """A chain of vectors just at the threshold: links are exactly the near pairs that share a filter, however sent."""
    rng, dim = np.random.default_rng(6), 32
    walk = [rng.standard_normal(dim)]
    for _ in range(599):
        x = walk[-1] / np.linalg.norm(walk[-1])
        z = rng.standard_normal(dim)
        z -= (z @ x) * x
        c = rng.uniform(0.949, 0.956)
        walk.append(c * x + np.sqrt(1 - c * c) * z / np.linalg.norm(z))
    rows = [(i, [float(e) for e in v]) for i, v in enumerate(walk)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [{r.vec_id: (r.n_links, r.component_id) for r in near_vectors(frame, block=64, chain=chain).collect()} for chain in (4096, 20)]
    x = units([v for _, v in rows])
    near = np.triu(x @ x.T >= 0.95, 1)
    lists = [set(f.tolist()) for f in fit_caps(dim, len(rows), 0.95).lists(x)]
    share = near & np.array([[bool(a & b) for b in lists] for a in lists])
    want = groups(len(rows), lambda a, b: share[min(a, b), max(a, b)])
    for links in got:
        assert links == {i: (int(share[i].sum() + share[:, i].sum()), want[i]) for i in range(len(rows))}
    assert share.sum() >= 0.95 * near.sum() > 300


def test_vectors_of_null_and_repeated_ids_and_lengths(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [1.0, 0.001, 0.0]
    rows = [(5, a), (5, a), (None, c), (7, b), (None, [2.0, 0.0]), (3, [-0.0, 2.0, 0.0]), (None, None)]
    frame = spark.createDataFrame([(i, v, 1, "clash", 0) for i, v in rows], "vec_id long, embedding array<double>, rep int, vector string, dim int")
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(frame).collect())
    assert got == Counter({(5, 2, 5, True): 2, (None, 2, 5, False): 1, (7, 1, 3, False): 1, (3, 1, 3, True): 1, (None, 0, None, False): 2})


def test_sketches_of_near_vectors_are_near():
    rng = np.random.default_rng(4)
    x = units(rng.standard_normal((4000, 24)))
    z = rng.standard_normal((4000, 24))
    z = units(z - (z * x).sum(1, keepdims=True) * x)
    caps = Caps(24, 8, 0.0)
    differing = np.bitwise_count((caps.sketches(x) ^ caps.sketches(0.95 * x + np.sqrt(1 - 0.95**2) * z)).view(np.uint64)).sum(axis=1)
    assert differing.max() <= most_differing(0.95) and np.median(np.bitwise_count((caps.sketches(x) ^ caps.sketches(z)).view(np.uint64)).sum(axis=1)) > 2 * most_differing(0.95)


def test_no_vectors(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_words_of_slices():
    import pyarrow as pa

    from tickloom.llm.tokens import word_bytes, words_of

    rng = random.Random(9)
    texts = [None if rng.random() < 0.1 else "".join(rng.choice("aBé« \t\n\x0b\x1c\x85\u00a0ñ!") for _ in range(rng.randint(0, 40))) for _ in range(500)]
    whole = pa.array(texts, pa.string())
    for at, n in ((0, 500), (17, 300), (250, 250), (499, 1)):
        words, counts = words_of(whole.slice(at, n))
        want = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")) for t in texts[at : at + n]]
        assert words.to_pylist() == [w for some in want for w in some]
        assert counts.tolist() == [len(some) for some in want]
        offsets, data = word_bytes(words)
        assert [bytes(data[a:b]).decode() for a, b in zip(offsets, offsets[1:])] == words.to_pylist()
