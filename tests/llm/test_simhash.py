"""SimHash: fingerprints, links and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from tollgate.llm import simhash
from tollgate.llm.components import components


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        parent[find(a)] = find(b)
    least = {}
    for n in nodes:
        least[find(n)] = min(least.get(find(n), n), n)
    return {n: least[find(n)] for n in nodes}


@pytest.mark.parametrize("text", ["", None, " \n", "One", "Two WORDS", "a b c", "ÀÉ à A a b c\x1cd", "x y " * 30_000])
def test_fingerprint(text):
    assert simhash.fingerprint(None if text is None else text.encode()) % (1 << 64) == brute_fingerprint(text)


def test_every_pair_within_the_bits_shares_an_anchor():
    patterns = simhash.anchor_patterns(1)
    assert [len(p) for p in patterns][:2] == [2, 17]
    rng = random.Random(2)

    def syndrome(half):
        s = 0
        for p in range(1, 32):
            if half >> (p - 1) & 1:
                s ^= p
        return s

    def near(half):
        return [half ^ e for e in patterns[syndrome(half)]]
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            b ^= 1 << bit
        halves = [((a >> s) & 0xFFFFFFFF, (b >> s) & 0xFFFFFFFF) for s in (0, 32)]
        assert any(near(x)[0] in near(y) for x, y in halves)


def links(spark, values, **how):
    fps = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    return {(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.near_links(fps, 3, **how).collect()}


def test_links_equal_brute_force(spark):
    rng = random.Random(4)
    values = [rng.getrandbits(64) for _ in range(30)]
    for v in list(values):
        for _ in range(8):
            w = v
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                w ^= 1 << bit
            values.append(w)
    values = sorted(set(values) | {0, 1, 7, 15, (1 << 64) - 1})
    want = {(a, b) for i, a in enumerate(values) for b in values[i + 1:] if (a ^ b).bit_count() <= 3}
    got = links(spark, values, home_limit=10_000)
    assert {tuple(sorted(p)) for p in got} == want
    # blocks of any size give the same components
    forest = links(spark, values, home_limit=1, block_rows=40)
    assert {tuple(sorted(p)) for p in forest} <= want
    assert classes(forest, values) == classes(want, values)


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randint(100, 180), rng.randint(100, 180)) for _ in range(50)]
    edges += [(500, i) for i in range(501, 560)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    real = [e for e in edges if None not in e and e[0] != e[1]]
    assert got == classes(real, {x for e in real for x in e})
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_documents(make_docs):
    base = " ".join(f"word{i}" for i in range(300))
    near = [base.replace("word150 ", f"other{k} ") for k in range(30)]
    rows = [(5, base), (3, base.upper()), (9, None), (2, ""), (7, " "), (None, base), (4, "short"), (4, "short"), (11, "long " * 20_000)]
    rows += [(100 + k, t) for k, t in enumerate(near)]
    docs = make_docs(rows)
    got = simhash.near_duplicates(docs).collect()
    prints = {t: brute_fingerprint(t) for _, t in rows}
    values = set(prints.values())
    want = classes({(a, b) for a in values for b in values if a != b and (a ^ b).bit_count() <= 3}, values)
    least = {}
    for i, t in rows:
        if i is not None:
            least[want[prints[t]]] = min(least.get(want[prints[t]], i), i)
    expected = sorted(((i, prints[t], least[want[prints[t]]]) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=repr) == expected
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


def test_edges(make_docs):
    assert simhash.near_duplicates(make_docs([])).count() == 0
    assert simhash.keep_one_of_each(make_docs([])).count() == 0
    nobody = make_docs([(None, "a b c"), (None, "a b c")])
    assert [r.component_id for r in simhash.near_duplicates(nobody).collect()] == [None, None]
    assert simhash.keep_one_of_each(nobody).count() == 1
    odd = make_docs([(1, "a b c", "en", "s", 7, 8), (2, "A b c", "en", "s", 9, 8)], ", fp long, component long")
    assert [tuple(r) for r in simhash.keep_one_of_each(odd).collect()] == [(1, "a b c", "en", "s", 5, 7, 8)]
