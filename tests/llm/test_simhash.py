import random

import numpy as np
import pytest
import xxhash

from regionflow.llm import simhash
from regionflow.llm.components import connected_components


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


TEXTS = [None, "", " \t\n", "one", "One TWO", "É x\x0by z w v", "a b c d", "a b c d e", "a  b\r\nc d e"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_equals_the_slow_one(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_fingerprint_of_a_very_long_text():
    rng = random.Random(1)
    text = " ".join(rng.choice("abcdefghij") for _ in range(70_000))
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_allocation_sums_and_is_least():
    rng = random.Random(2)
    for _ in range(30):
        costs = [sorted(rng.random() for _ in range(4)) for _ in range(3)]
        cost, ts = simhash.allocate(costs, 1)
        assert sum(ts) == 1
        every = [(a, b, 1 - a - b) for a in range(-1, 3) for b in range(-1, 3) if -1 <= 1 - a - b <= 2]
        assert cost == pytest.approx(min(sum(c[t + 1] for c, t in zip(costs, x)) for x in every))


@pytest.mark.parametrize("parts", [None, 3])
@pytest.mark.parametrize("block", [8])
def test_links_equal_brute_force(spark, parts, block):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for seed in fps[:6]:  # groups of near copies and chains of them
        x = seed
        for _ in range(25):
            fps.append(x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
            x = rng.choice((x, fps[-1]))
    fps = sorted(set(fps))
    nodes = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")
    counts = simhash.bit_counts(nodes)
    share = np.diag(counts) / len(fps)
    if parts is None:
        chosen = simhash.plan(counts, len(fps))
    else:
        grouped = simhash.group_bits(counts, len(fps), parts)
        chosen = list(zip(grouped, simhash.allocate([simhash.part_cost(b, share, len(fps), 4) for b in grouped], 5 - parts)[1]))
    assert sum(t for _, t in chosen) == 4 - len(chosen) + 1
    assert sorted(b for bits, _ in chosen for b in bits) == list(range(64))
    edges = simhash.verify(simhash.index_rows(nodes, chosen), 4, block)
    got = {(r.a % 2**64, r.b % 2**64) for r in edges.collect()}
    at = {x: i for i, x in enumerate(fps)}
    true = [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 4]
    assert roots(len(fps), [(at[a], at[b]) for a, b in got]) == roots(len(fps), true)
    found = {r.node % 2**64: r.root for r in connected_components(edges).collect()}
    want = roots(len(fps), true)
    linked = [i for i in range(len(fps)) if want.count(want[i]) > 1]
    assert set(found) == {fps[i] for i in linked}
    for i in linked:
        for j in linked:
            assert (found[fps[i]] == found[fps[j]]) == (want[i] == want[j])


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.range(n - 1).selectExpr("id as a", "id + 1 as b")
    got = connected_components(edges)
    assert got.count() == n and got.select("root").distinct().count() == 1
    assert connected_components(edges.limit(0)).count() == 0


def test_groups_of_a_small_table(spark):
    rng = random.Random(4)
    base = [" ".join("w%d" % rng.randrange(500) for _ in range(80)) for _ in range(4)]
    near = base[0].rsplit(" ", 1)[0] + " changed"
    rows = [(9, base[0], 1), (7, near, 2), (8, base[0], 3), (8, base[0], 4), (3, base[1], 5), (None, base[1], 6), (None, base[2], 7), (5, None, 8), (4, "", 9), (6, " ", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k_text int")
    want = {}
    f = [slow_fingerprint(r[1]) for r in rows]
    comp = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if bin(f[i] ^ f[j]).count("1") <= 4])
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if comp[j] == comp[i] and rows[j][0] is not None]
        want.setdefault((r[0], min(ids, default=None), f[i]), 0)
        want[r[0], min(ids, default=None), f[i]] += 1
    got = {}
    for r in simhash.near_groups(docs).collect():
        k = (r.k_id, r.component_id, r.fp % 2**64)
        got[k] = got.get(k, 0) + 1
    assert got == want
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(comp))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({k[1] for k in want} - {None})
    assert simhash.near_dedup(docs.limit(0)).count() == 0
