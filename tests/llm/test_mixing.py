"""Mixing: exponent, weights, whole epochs and the cut, against a brute-force mix."""

import hashlib
from math import log

import pytest
from pyspark.sql import functions as F

from tollgate.llm import mixing


def brute(rows, entropy, repeats, budget, block_tokens):
    """(doc, epoch, block) of the mix, one document at a time; rows: (id, source, words)."""
    rows = [r for r in rows if r[2]]
    total = sum(n for _, _, n in rows)
    tokens = {}
    for _, s, n in rows:
        tokens[s] = tokens.get(s, 0) + n
    p = {s: t / total for s, t in tokens.items()}

    def weights(a):
        z = sum(x ** a for x in p.values())
        return {s: x ** a / z for s, x in p.items()}

    def h(a):
        return -sum(w * log(w) for w in weights(a).values())

    def most(a):
        return max(w * budget / p[s] for s, w in weights(a).items())
    need = entropy * log(len(p))
    lo, hi = (1.0, 1.0) if h(1.0) >= need else (0.0, 1.0)
    for _ in range(40):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if h(mid) >= need else (lo, mid)
    lo2, hi2 = (0.0, 0.0) if most(0.0) <= repeats else (0.0, 1.0)
    for _ in range(40):
        mid = (lo2 + hi2) / 2
        lo2, hi2 = (lo2, mid) if most(mid) <= repeats else (mid, hi2)
    a, out = max(lo, hi2), []
    for s, w in weights(a).items():
        quota, blocks = int(w * (total * budget)), -(-tokens[s] // block_tokens)
        for epoch in range(quota // tokens[s] + 1):
            def place(i):
                d = int(hashlib.md5(f"{mixing.SEED}:{epoch}:{'null' if i is None else i}".encode()).hexdigest()[:15], 16)
                return d % blocks, d
            used = epoch * tokens[s]
            for i, _, n in sorted((r for r in rows if r[1] == s), key=lambda r: place(r[0])):
                if used < quota:
                    out.append((i, epoch, place(i)[0]))
                used += n
    return a, sorted(out, key=repr)


@pytest.mark.parametrize("entropy, repeats, budget, block", [
    (0.95, 4.0, 1.0, 1 << 20), (0.99, 100.0, 1.0, 50), (0.95, 1.5, 1.0, 30), (0.3, 4.0, 0.5, 40), (1.0, 50.0, 2.5, 64)])
def test_mix_equals_brute_force(make_docs, entropy, repeats, budget, block):
    rows = [(i, "big" if i % 3 else ("mid" if i % 2 else None), 1 + i * 7 % 40) for i in range(150)]
    rows += [(1000 + i, "tiny", 5) for i in range(3)] + [(2000, "tiny", 0)]
    docs = make_docs([(i, " ".join(["w"] * n), "en", s) for i, s, n in rows])
    _, want = brute(rows, entropy, repeats, budget, block)
    got = mixing.mix(docs, target_entropy=entropy, max_repeats=repeats, budget=budget, block_tokens=block)
    assert sorted(((r.doc_id, r.epoch, r.block) for r in got.collect()), key=repr) == want
    assert got.filter("turn < 0 or turn > 1").count() == 0


def test_edges(make_docs):
    none = mixing.mix(make_docs([]))
    assert none.count() == 0 and none.columns[-4:] == ["n_tokens", "epoch", "block", "turn"]
    assert mixing.mix(make_docs([None, "", " \t\n"])).count() == 0
    one = mixing.mix(make_docs([(None, "a b", "en", None), (None, "a b", "en", None), (3, "c " * 50_000, "en", None)]))
    assert sorted(r.n_tokens for r in one.collect()) == [2, 2, 50_000]
    odd = make_docs([(1, "a b", "en", "s", "mine", 9)], ", mix_source string, epoch long")
    row = mixing.mix(odd).first()
    assert row.mix_source == "mine" and row.epoch == 0


def test_words_are_cut_at_ascii_space_only(spark):
    df = spark.createDataFrame([("a b c\x1cd\te\x0bf\x0cg\rh\ni ",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(mixing.n_words(F.col("t"))).collect()] == [7, 0, 0]
