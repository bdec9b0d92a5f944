import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tollgate.llm import manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    fields = (doc_id, source, lang, n_chars, text)
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def up(nodes):
    """All levels of a tree over ``nodes``."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(*below[i:i + 3]) for i in range(0, len(below), 3)])
    return levels


def by_hand(rows, altered):
    """Leaf digest -> (subroot, root, proof, folded root) by whole lists; rows are (id, text, lang, source, n)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append((r[0] is not None, r[0] or 0, leaf(*r), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: up([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    whole = up([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (_, _, own, r) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            now = own if altered(r) is None else leaf(r[0], altered(r), *r[2:])
            beside, p = "", i
            for levels, at in ((trees[s], i), (whole, k)):
                p = at
                for nodes in levels[:-1]:
                    run = p - p % 3
                    left, right = nodes[run:p], nodes[p + 1:run + 3]
                    beside += "".join(left + right)
                    now = H(*left, now, *right)
                    p //= 3
            out.append((r[0], own, trees[s][-1][0], whole[-1][0], H(beside), now))
    return sorted(out, key=repr)


def rows_of(n):
    sources = [None, "", "a", "b", "ä", "hot"]
    made = []
    for i in range(n):
        source = sources[i % 5] if i % 3 else "hot"
        text = (None, "", "one\ntwo\n", "no break", "\n")[i % 5] if i % 7 else f"line {i}\nnext"
        made.append((i * 10, text, (None, "en")[i % 2], source, None if i % 11 == 0 else i))
    return made


def cut(r):
    return None if r[0] is None or r[0] % 20 or r[1] is None else r[1].replace("\n", "")


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos string, n string, digest string, leaf int"


def built(spark, rows):
    docs = spark.createDataFrame([(*r, "clash", "clash", "clash", 1) for r in rows], SCHEMA)
    altered = F.when(F.col("doc_id") % 20 == 0, F.regexp_replace("text", "\n", ""))
    got = manifest.build(docs, altered)
    proof = F.sha2(manifest.siblings(F.col("way")), 256).alias("proof")
    return got.select("doc_id", "leaf", "subroot", "root", proof, F.element_at("version", -1).alias("folded"))


@pytest.mark.parametrize("n, levels", [(1, 6), (2, 1), (3, 1), (4, 1), (28, 1), (90, 1), (90, 2), (300, 2), (300, 6)])
def test_equals_whole_lists(spark, monkeypatch, n, levels):
    monkeypatch.setattr(manifest, "LEVELS", levels)        # small blocks: several storeys
    rows = rows_of(n)
    assert sorted(map(tuple, built(spark, rows).collect()), key=repr) == by_hand(rows, cut)


def test_null_equal_ids_and_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(manifest, "LEVELS", 1)
    rows = rows_of(20) + [(None, "x\n", "en", "a", 1), (None, None, None, None, None), (40, "other", "en", "a", 2),
                          (40, "z", "en", "a", 2), (50, "same\n", "en", "b", 1), (50, "same\n", "en", "b", 1)]
    assert sorted(map(tuple, built(spark, rows).collect()), key=repr) == by_hand(rows, cut)


def test_empty_table(spark):
    assert built(spark, rows_of(3)[:0]).count() == 0


def test_versions_share_what_they_do_not_copy(spark, monkeypatch):
    monkeypatch.setattr(manifest, "LEVELS", 2)
    rows = [(i, f"t\n{i}", "en", "one", i) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA.split(", pos")[0])
    changed = manifest.build(docs, F.when(F.col("doc_id") == 5, F.lit("altered"))).collect()
    base = {r.doc_id: r for r in manifest.build(docs).collect()}
    assert len({r.root for r in changed} | {r.root for r in base.values()}) == 1      # the base tree stays
    for r in changed:
        path = base[r.doc_id].version
        assert path[0] == r.leaf and path[-1] == r.root and len(path) == len(r.way) + 1
        if r.doc_id == 5:       # a copy of each ancestor, and of nothing else
            assert not set(r.version) & set(path) and r.way == base[5].way
        else:
            assert r.version == path
    siblings_of = {r.doc_id: r.way for r in changed}
    assert base[5].version[0] in siblings_of[4][0].left + siblings_of[4][0].right     # others still see the original


def test_no_group_in_one_task(spark):
    """Blocks are bounded however large a source is, and the last join is per block."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"),
                                    F.lit(1).alias("n_chars"), F.col("id").cast("string").alias("text"))
    leaves = docs.select("doc_id", "source", manifest.packed(manifest.leaf()).alias("digest"))
    storeys = manifest.storeys(manifest.placed(leaves, "source", ["doc_id", "digest"]), "source")
    sizes = [sorted(r[0] for r in s.select(F.size("nodes")).collect()) for s in storeys]
    assert sizes == [[84, 729, 729, 729, 729], [5]]
