"""Fingerprints and components against brute force, with crowded cells and without."""

from __future__ import annotations

import random
import re

import xxhash
from pyspark.sql import functions as F

from weftline.llm import graph, simhash


def fingerprint(text, each=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + each]) for i in range(max(1, len(words) - each + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def roots(prints, bits=2):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    some = list(parent)
    for i, a in enumerate(some):
        for b in some[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                parent[find(a)] = find(b)
    return {p: find(p) for p in parent}


def test_components_of_frames(odd_documents, no_documents):
    rows = odd_documents.collect()
    of = {r.text: fingerprint(r.text) for r in rows}
    root = roots(set(of.values()))
    least: dict = {}
    for r in rows:
        if r.doc_id is not None:
            k = root[of[r.text]]
            least[k] = min(least.get(k, r.doc_id), r.doc_id)
    got = simhash.near_duplicates(odd_documents).collect()
    assert len(got) == len(rows)
    assert sorted((str(r.doc_id), r.fp % 2**64, r.component_id) for r in got) == sorted((str(r.doc_id), of[r.text], least.get(root[of[r.text]])) for r in rows)
    kept = simhash.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns and kept.count() == len({root[of[r.text]] for r in rows})
    assert simhash.near_duplicates(no_documents).count() == 0 and simhash.keep_one(no_documents).count() == 0


def test_links_connect_all_that_are_near(spark):
    rng = random.Random(3)
    prints = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(25):
            prints.add(x)
            for _ in range(rng.randint(0, 3)):
                x ^= 1 << rng.randrange(64)
    prints |= {0, 2**64 - 1, 1 << 63, 3}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    nodes = spark.createDataFrame(signed, "fp long")
    want = {}
    for p, r in roots(prints).items():
        want.setdefault(r, set()).add(p)
    for crowded in (1000, 10, 3, 0):
        links = simhash.links(nodes, 2, crowded)
        assert all(((r.u ^ r.v) % 2**64).bit_count() <= 2 for r in links.collect())
        found = {r.v % 2**64: r.root % 2**64 for r in graph.components(links).collect()}
        groups: dict = {}
        for p in prints:
            groups.setdefault(found.get(p, p), set()).add(p)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values())), crowded


def test_stars_settle_on_long_paths(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([(a, b) for a, b in zip(order, order[1:], strict=False)] + [(1000, 1001), (1001, 1000)], "u long, v long")
    got = {r.v: r.root for r in graph.components(edges).collect()}
    assert got == {i: 0 for i in range(1, n)} | {1001: 1000}
    assert graph.components(edges.where(F.lit(False))).count() == 0
