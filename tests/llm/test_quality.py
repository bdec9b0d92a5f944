"""Quality classifier: held-out verdicts, exchange of pseudo-labels, edge rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from tollgate.llm import quality

SF = "/root/testdata/sf0.1"


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    model = quality.train(docs, labels.filter(~fold))
    got = quality.score(docs, model).join(quality.labels_of(labels.filter(fold)), "doc_id")
    r = got.groupBy("clean").agg(F.avg(F.col("kept").cast("double")).alias("kept")).collect()
    kept = {x.clean: x.kept for x in r}
    assert kept[1] > 0.98 and kept[0] < 0.05
    assert model.text.slope > 0
    same = quality.keep_clean(docs, model).select("doc_id").subtract(quality.score(docs, model).filter("kept").select("doc_id"))
    assert same.count() == 0


def test_views_exchange_pseudo_labels():
    """The metadata view is perfect; only few texts are labelled. Pseudo-labels teach the text view more words."""
    rng = np.random.default_rng(5)

    def doc(clean):
        words = rng.choice(600, 4) + (0 if clean else 600)
        return (np.unique([zlib.crc32(f"w{w}".encode()) % quality.FEATURES for w in words]).astype(np.int32),
                np.array([7 if clean else 9], np.int32))
    kinds = rng.random(600) < 0.5
    text, meta = map(list, zip(*[doc(k) for k in kinds]))
    free_kinds = rng.random(3000) < 0.5
    free_text, free_meta = map(list, zip(*[doc(k) for k in free_kinds]))
    flat = lambda rows: (np.concatenate(rows), np.array([len(r) for r in rows]))
    exchange = lambda views: quality.tally(views, [flat(free_text), flat(free_meta)])
    alone = quality.co_train(text, meta, kinds, exchange, rounds=0)
    taught = quality.co_train(text, meta, kinds, exchange, rounds=3)
    hits = [np.mean([(m.text.raw(t) > 0) == k for t, k in zip(free_text, free_kinds)]) for m in (alone, taught)]
    assert hits[1] > hits[0] + 0.1, hits


def test_a_word_of_unlabelled_documents_alone_is_learned(make_docs, spark):
    """The source gives them away; the word is in no labelled text, and in few of very many unlabelled ones."""
    rng = np.random.default_rng(3)

    def words(own):
        return " ".join([*(f"n{w}" for w in rng.integers(0, 40, 12)), *own])
    rows = [(i, words(["fine"] if i % 2 else ["junk"]), "en", "good" if i % 2 else "bad") for i in range(1200)]
    rows += [(2000 + i, words([]), "en", "good" if i % 2 else "bad") for i in range(5000)]
    rows += [(9000 + i, words(["zzmarker"]), "en", "bad") for i in range(60)]
    docs, labels = make_docs(rows), spark.createDataFrame([(i, i % 2, 0) for i in range(1200)], "doc_id long, quality int, toxic int")
    alone, taught = (quality.train(docs, labels, rounds=r) for r in (0, 3))
    plain, marked = "n1 n2 n3 n4 n5 n6", "n1 n2 n3 n4 n5 zzmarker"
    drop = [m.text.raw(quality.text_features(plain)) - m.text.raw(quality.text_features(marked)) for m in (alone, taught)]
    assert abs(drop[0]) < 0.5 and drop[1] > 1.5, drop


def test_tally_by_brute_force():
    rng = np.random.default_rng(8)
    rows = [[np.unique(rng.integers(0, 50, rng.integers(1, 9))).astype(np.int32) for _ in range(200)] for _ in (0, 1)]
    views = [quality.View(rng.normal(0, 3, quality.FEATURES).astype(np.float32), 0.1, 1.3, -0.2) for _ in (0, 1)]
    flat = [(np.concatenate(r), np.array([len(x) for x in r])) for r in rows]
    want = np.zeros((2, 2, quality.FEATURES + 1), int)
    for a, b in zip(*rows):
        for k, (own, other, view) in enumerate(((a, b, views[1]), (b, a, views[0]))):
            p = 1 / (1 + np.exp(-view.logit(other)))
            kind = 1 if p >= quality.CERTAIN else 0 if 1 - p >= quality.CERTAIN else None
            if kind is not None:
                want[k, kind, own] += 1
                want[k, kind, quality.FEATURES] += 1
    got = quality.tally(views, flat)
    assert np.array_equal(got, want) and got.sum() > 0
    half = [[(np.concatenate(r[part]), np.array([len(x) for x in r[part]])) for r in rows] for part in (slice(0, 77), slice(77, 200))]
    assert np.array_equal(sum(quality.tally(views, h) for h in half), want)


def test_fit_separates_tiny_data():
    """Logistic regression on a feature that settles the label and one that does not."""
    rows = [np.array([1, 5], np.int32) if i % 2 else np.array([2, 5], np.int32) for i in range(40)]
    clean = np.arange(40) % 2 == 1
    view = quality.fit(rows, clean)
    assert view.weights[1] > 0.5 and view.weights[2] < -0.5 and view.weights[5] == 0 and not view.weights[6:].any()
    assert all((view.raw(r) > 0) == k for r, k in zip(rows, clean))
    p = 1 / (1 + np.exp(-np.array([view.raw(r) for r in rows])))            # stationary: gradient and ridge balance
    for f in (1, 2):
        gradient = sum(x - k for r, x, k in zip(rows, p, clean) if f in r) + quality.RIDGE * view.weights[f]
        assert abs(gradient) < 0.3


def test_edges(spark, make_docs):
    kinds = "doc_id long, quality int, toxic int"
    docs = make_docs([(1, "good text", "en", "a"), (2, None, None, None), (None, "", "en", "a"), (1, "good text", "en", "a")])
    none = quality.train(docs, spark.createDataFrame([], kinds))
    assert none is None and quality.score(docs, none).filter("kept and score = 1").count() == 4
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (2, None, None), (3, 1, None), (4, 0, None), (None, 1, 0), (5, None, 1)], kinds)
    got = {r.doc_id: r.clean for r in quality.labels_of(labels).collect()}
    assert got == {1: 0, 3: 1, 4: 0, 5: 0}
    many = make_docs([(i, ("fine words here " if i % 2 else "BAD!! BAD!! ") * (i % 5 + 1), "en", "a") for i in range(80)])
    marks = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], kinds)
    model = quality.train(many, marks)
    assert {r.doc_id % 2: r.kept for r in quality.score(many, model).collect()} == {0: False, 1: True}
    odd = quality.score(make_docs([(7, None, None, None), (8, "x " * 100_000, "en", "a")]), model).collect()
    assert all(0 <= r.score <= 1 for r in odd) and len(odd) == 2
    empty = quality.keep_clean(many.limit(0), model)
    assert empty.count() == 0 and empty.schema == many.schema
    wide = make_docs([(1, "fine words here", "en", "a", 0.5, True)], ", score double, kept boolean")
    assert quality.keep_clean(wide, model).collect() == wide.collect()
