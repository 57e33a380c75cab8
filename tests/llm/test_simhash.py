import random

import numpy as np
import xxhash

from relaymart.llm import simhash as s
from tests_llm_rows import MESSY, doc


def slow(text):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    shingles = [b" ".join(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, most=4):
    fps = np.array(sorted(fps), np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= most
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(axis=1)
        if (new == label).all():
            return {int(f): int(fps[k]) for f, k in zip(fps, label)}
        label = new


def planted(seed, centers=12, around=25):
    """Fingerprints near some centers, and far ones."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(200)} | {0, s.ALL_BITS}
    for _ in range(centers):
        c = rng.getrandbits(64)
        for _ in range(around):
            f = c
            for b in rng.sample(range(64), rng.randint(0, 7)):
                f ^= 1 << b
            out.add(f)
    return out


def grouped(rows):
    out = {}
    for node, root in rows:
        out.setdefault(root, set()).add(node)
    return sorted(map(sorted, out.values()))


def test_fingerprint_by_definition():
    for _, text, *_ in MESSY[:8] + [doc(0, "A b C d"), doc(0, "a a a a a a"), doc(0, "É b\x1fc\x0bd e f")]:
        assert s.fingerprint(text) == slow(text)


def search(spark, fps, bucket):
    nodes = spark.createDataFrame([(s._signed(f),) for f in fps], "fp long")
    roots = {r.node: r.root for r in s.components(s.links(nodes, bucket=bucket)).collect()}
    return [(f, roots.get(s._signed(f), s._signed(f))) for f in fps]


def test_components_against_brute_force(spark, corpus):
    fps = planted(1)
    assert grouped(search(spark, fps, s.BUCKET)) == grouped(brute_components(fps).items())


def test_heavy_buckets_are_dealt_anew(spark, corpus):
    fps = planted(2, centers=3, around=60)
    assert grouped(search(spark, fps, bucket=2)) == grouped(brute_components(fps).items())


def test_allotment_covers_every_pair():
    rng = np.random.default_rng(3)
    for n in (10, 10**6, 10**12):
        p = rng.uniform(0.2, 0.8, 64)
        plan = s.allot(n, np.outer(p, p) * n + np.diag(p * (1 - p)) * n)
        bits = [b for part, _ in plan for b in part]
        assert len(bits) == len(set(bits)) and sum(t + 1 for _, t in plan) > s.MAX_BITS


def test_groups_of_messy_rows(corpus):
    near = "one two three four five six seven eight nine ten " * 30
    rows = MESSY + [doc(20, near), doc(21, near + "eleven"), doc(19, near.upper())]
    docs = corpus(rows).selectExpr("*", "'x' as fingerprint", "1 as fp", "2 as row")
    out = s.groups(docs).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    assert got[2].fingerprint == "0" * 16 and {got[i].component_id for i in (2, 3, 4)} == {2}
    assert {got[i].component_id for i in (19, 20, 21)} == {19}
    assert got[1].fingerprint == f"{slow(MESSY[0][1]):016x}"
    stay = s.one_of_each(docs).collect()
    assert sorted(x for x in (r.doc_id for r in stay) if x is not None) == [1, 2, 5, 6, 7, 8, 19]
    assert stay[0].__fields__ == docs.columns


def test_empty_table(corpus):
    assert s.groups(corpus([])).count() == 0
    assert s.one_of_each(corpus([])).count() == 0
