"""Class-based scores against counts by hand, a proper distribution, and exchange against a search."""

import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollgate.llm import brown, queries


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def class_for(model, w):
    rank = {x: i for i, x in enumerate(model.words)}
    c = model.classes
    return int(c.end if w == b"" else c.of_rank[rank[w]] if w in rank else c.of_tail[brown.tail_group(w)])


def by_hand(model, of, counts, text):
    """log10 probability of a text, one token at a time."""
    total, before = 0.0, model.classes.end
    for w in tokens(text):
        c = of(w)
        total += log10(counts[w] + 0.1) + model.step[before, c]
        before = c
    return total


@pytest.mark.parametrize("frequent, first, sweeps", [(1 << 18, 1024, 2), (1 << 18, 20, 1), (40, 15, 2), (0, 0, 1)])
def test_scores_and_base(spark, frequent, first, sweeps):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn(
        "held_out", F.coalesce(queries.crc_of_id(10) == 0, F.lit(False)))
    rows = docs.collect()
    train = [r.text for r in rows if zlib.crc32(str(r.doc_id).encode()) % 10]
    counts = Counter(w for t in train for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    model, table = brown.learn(docs.filter(queries.crc_of_id(10) != 0), frequent=frequent, first=first, sweeps=sweeps)
    assert (model.total, model.distinct) == (n, v)
    known = {w: class_for(model, w) for w in {w for r in rows for w in tokens(r.text)} | set(counts)}
    got = {r.doc_id: r for r in brown.score(docs, model, table, "held_out").collect()}
    for r in rows:
        g, w = got[r.doc_id], tokens(r.text)
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (
            zlib.crc32(str(r.doc_id).encode()) % 10 == 0, len(w), sum(counts[x] > 0 for x in w), n)
        assert g.base_score == pytest.approx(sum(log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), abs=1e-6)
        assert g.score == pytest.approx(by_hand(model, known.get, counts, r.text), abs=1e-6)
    # from every class, the words of all classes (one unseen word where there is a tail group) sum to 1
    mass = np.zeros(model.step.shape[0])
    for w, c in counts.items():
        mass[known[w]] += c + 0.1
    for k in set(model.classes.of_tail):
        mass[k] += 0.1
    assert ((10.0 ** model.step) * mass).sum(axis=1) == pytest.approx(1, abs=1e-6)
    # transitions are those of the training texts in these classes, interpolated by Witten and Bell
    table = np.zeros_like(model.step)
    for t in train:
        of = [model.classes.end, *(known[w] for w in tokens(t))]
        np.add.at(table, (of[:-1], of[1:]), 1)
    kinds = np.maximum((table > 0).sum(axis=1), 1)[:, None]
    p = (table + kinds * mass / mass.sum()) / (table.sum(axis=1)[:, None] + kinds)
    live = mass > 0
    assert (10.0 ** model.step * mass)[:, live] == pytest.approx(p[:, live], rel=1e-6)


def test_every_word_with_evidence_moves_by_its_neighbours(spark, make_docs):
    """Contexts and best classes against plain loops; words far beyond the first ones move, too."""
    rng = np.random.default_rng(2)
    texts = [" ".join(f"{'ab'[(i + k) % 2]}{rng.integers(0, 40)}" for k in range(int(rng.integers(2, 30)))) for i in range(120)] + [None, "", "once"]
    docs = make_docs(texts)
    model, _ = brown.learn(docs, first=6, classes=5, sweeps=0)
    words, start = model.words, model.classes
    movable = sum(c >= 4 for c in model.counts[:-1])
    ranks = brown.write_ranks(docs, words)
    contexts = brown.count_contexts(ranks, start, movable)
    rank, want, table = {w: i for i, w in enumerate(words)}, Counter(), np.zeros((brown.CLASSES, brown.CLASSES))
    of = {w: class_for(model, w) for t in texts for w in tokens(t)}
    for t in texts:
        own = tokens(t)
        for i, w in enumerate(own):
            before = of[own[i - 1]] if i else start.end
            table[before, of[w]] += 1
            if w and rank[w] < movable:
                want[rank[w], before] += 1
                want[rank[w], brown.CLASSES + of[own[i + 1]]] += 1
    got = {(r.key // (2 * brown.CLASSES), r.key % (2 * brown.CLASSES)): r.n for r in contexts.filter("key >= 0").collect()}
    assert got == want and np.array_equal(brown.bigrams_of(contexts), table)
    t = table + 0.5
    new = brown.moved(contexts, start)
    for r in range(len(words)):
        if r >= movable:
            assert new.of_rank[r] == start.of_rank[r]
            continue
        gain = [sum(n * (np.log(t[code, b] / t[:, b].sum()) if code < brown.CLASSES else np.log(t[b, code - brown.CLASSES] / t[b].sum()))
                    for (word, code), n in want.items() if word == r) for b in range(start.end)]
        assert gain[new.of_rank[r]] == pytest.approx(max(gain))
    final, _ = brown.learn(docs, first=6, classes=5, sweeps=4, evidence=4)
    kinds = [Counter(int(final.classes.of_rank[rank[w]]) for w in words[:movable] if w[:1] == k) for k in (b"a", b"b")]
    assert sum((kinds[0] & kinds[1]).values()) == 0          # a words follow b words and the other way round: no class mixes them


def test_better_than_the_base_on_held_out_texts(spark):
    got = brown_scores = queries.QUERIES["op8_lm_brown_classes"](spark, "/root/testdata/sf0.01")
    r = brown_scores.filter("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    n = got.filter("held_out").agg(F.sum("n_tokens")).first()[0]
    assert got.count() == 1000 and r[1] > r[0] and 10 ** (-r[1] / n) < 8262       # the perplexity with 1024 movable words


def likelihood(pairs, of):
    member = np.zeros((len(pairs), of.max() + 1))
    member[np.arange(len(pairs)), of] = 1
    table = member.T @ pairs @ member
    return brown._xlogx(table).sum() - brown._xlogx(table.sum(axis=0)).sum() - brown._xlogx(table.sum(axis=1)).sum()


def test_exchange_moves_as_a_full_evaluation_would():
    rng = np.random.default_rng(0)
    for _ in range(5):
        pairs = rng.integers(0, 5, (12, 12)).astype(float)
        order = [s for s in np.argsort(-pairs.sum(axis=0), kind="stable") if s != 11]
        want = np.full(12, 3)
        want[order] = np.arange(11) % 3
        for s in order:
            values = [likelihood(pairs, np.where(np.arange(12) == s, c, want)) for c in range(3)]
            if max(values) > values[want[s]] + 1e-9:
                want[s] = int(np.argmax(values))
        assert brown.exchange(pairs, 11, classes=4, sweeps=1).tolist() == want.tolist()


def test_exchange_finds_the_planted_classes():
    rng = np.random.default_rng(1)
    kind = np.array([0, 1] * 10 + [2])
    pairs = np.zeros((21, 21))
    for _ in range(4000):                                      # words of kind 0 and 1 take turns; 20 is the end
        a, b = rng.integers(0, 20, 2)
        if kind[a] != kind[b]:
            pairs[a, b] += 1
    pairs[20, :20] = pairs[:20, 20] = 1
    of = brown.exchange(pairs, 20, classes=3)
    assert len({tuple(sorted({int(of[i]) for i in range(20) if kind[i] == k})) for k in (0, 1)}) == 2
    assert all(len({int(of[i]) for i in range(20) if kind[i] == k}) == 1 for k in (0, 1)) and (of == of[20]).sum() == 1


def test_edges(spark, make_docs):
    docs = make_docs([(1, None), (None, "a b"), (2, ""), (3, "The the THE É é " + "z" * 100 + " x" * 60_000), (3, "rare"), (3, "rare")])
    docs = docs.withColumn("n", F.lit("kept"))
    model, table = brown.learn(docs.filter("doc_id = 3"))
    got = brown.score(docs, model, table, "n").collect()
    assert len(got) == 6 and {r.n for r in got} == {"kept"}
    assert {r.n_tokens for r in got if r.doc_id in (1, 2)} == {1}
    assert len({r.score for r in got if r.doc_id == 3 and r.n_tokens == 2}) == 1
    model, table = brown.learn(docs.limit(0))
    none = brown.score(docs, model, table, "n").collect()
    assert all(r.base_score == pytest.approx(0, abs=1e-9) and r.score == pytest.approx(0, abs=1e-9)
               and r.n_known == r.train_tokens == 0 for r in none)
    assert brown.score(docs.limit(0), model, table, "n").count() == 0
