import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from docuweft.llm import simhash
from docuweft.llm.components import components


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def parts_of(nodes, edges):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("text", [
    None, "", " \t\n", "one", "One two", "one  two\x0bthree", "a b c d e f g h", "ÀÉ é A\u00a0B c D", "x " * 50_000, "\u2003 wide space", "r\r\ns t u",
])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def near_groups(rng, groups=12, members=40):
    """Fingerprints in balls of few bits around some centres, and others."""
    found = [rng.getrandbits(64) for _ in range(50)] + [0]
    for _ in range(groups):
        value = rng.getrandbits(64)
        for _ in range(members):
            found.append(value)
            for _ in range(rng.randrange(1, 4)):
                value ^= 1 << rng.randrange(64)
    return sorted(set(found))


@pytest.mark.parametrize("max_bits", [1, 2])
def test_links_join_what_all_pairs_would(spark, max_bits):
    values = near_groups(random.Random(max_bits))
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), max_bits).collect()
    near = [(int(np.uint64(a).astype(np.int64)), int(np.uint64(b).astype(np.int64))) for a, b in combinations(values, 2) if (a ^ b).bit_count() <= max_bits]
    assert near
    assert parts_of(signed, [(r["a"], r["b"]) for r in found]) == parts_of(signed, near)


def test_long_lists_are_verified_as_short_ones():
    rng = random.Random(4)
    values = np.array(sorted({0xAB00 << 32 | rng.randrange(1 << 16) for _ in range(2000)}), dtype=np.uint64)
    assert len(values) > simhash.SMALL_LIST
    a, b = simhash.verified_pairs(values, 2)
    wanted = {(i, j) for i, j in combinations(range(len(values)), 2) if (int(values[i]) ^ int(values[j])).bit_count() <= 2}
    assert set(zip(a.tolist(), b.tolist())) == wanted


def test_components_of_long_chains_and_stars(spark):
    chain = [(n, n + 1) for n in range(1000, 1400)]
    star = [(5, n) for n in range(2000, 2300)]
    loose = [(1, 1), (3, 2), (2, 3)]
    edges = chain + star + loose
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges for n in e} - {1}
    wanted = parts_of(nodes, [e for e in edges if e[0] != e[1]])
    assert found.keys() == nodes
    assert len(set(zip(found.values(), (wanted[n] for n in found)))) == len(set(found.values())) == len(set(wanted.values()))


def test_near_duplicates_as_by_brute_force(spark):
    rng = random.Random(6)
    words = [f"w{n}" for n in range(400)]
    rows = []
    for n in range(60):
        text = " ".join(rng.choices(words, k=rng.randrange(0, 300)))
        rows += [(10 * n + m, text + " tail" * (m == 2)) for m in range(rng.randrange(1, 5))]
    rows += [(5000, None), (5001, ""), (5001, ""), (None, rows[3][1]), (None, "only a null id")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component_id string")
    found = simhash.near_duplicates(frame).collect()
    marks = [(d, plain_fingerprint(t)) for d, t in rows]
    different = sorted({m for _, m in marks})
    parts = parts_of(different, [(a, b) for a, b in combinations(different, 2) if (a ^ b).bit_count() <= 2])
    smallest = {}
    for d, m in marks:
        if d is not None:
            smallest[parts[m]] = min(d, smallest.get(parts[m], d))
    wanted = sorted((str(d), m, smallest.get(parts[m])) for d, m in marks)
    assert sorted((str(r["doc_id"]), r["fingerprint"] % (1 << 64), r["component_id"]) for r in found) == wanted


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
