"""Repeated word windows against a search over all windows."""

import hashlib
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tollgate.llm import substring
from tollgate.llm.rolling import sliding_min, word_hashes


def brute(rows, window):
    """(id, words, removed, digest); windows that start in a document with a smaller id. Null is the smallest."""
    order = lambda i: -1 if i is None else i
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            first[k] = min(first.get(k, order(i)), order(i))
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < order(i):
                gone.update(range(p, p + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(make_docs, rows, window, anchor):
    got = substring.remove_repeats(make_docs(rows), window=window, anchor_words=anchor)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, window)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=30).map(" ".join), min_size=1, max_size=8),
       st.sampled_from([(3, 1), (5, 2), (8, 8)]))
def test_random_texts_equal_brute_force(make_docs, texts, sizes):
    check(make_docs, list(enumerate(texts)), *sizes)


def test_passages_copies_edits_and_periodic_texts(make_docs):
    rng = random.Random(11)

    def words(n):
        return [f"w{rng.randint(0, 5000)}" for _ in range(n)]
    passage, doc = words(57), words(400)
    rows = [(i, " ".join(words(rng.randint(0, 60)) + passage + words(rng.randint(0, 60)))) for i in range(40)]
    rows += [(100 + i, " ".join(doc)) for i in range(30)]
    for i in range(30):                                       # near copies, each with one word changed
        near = list(doc)
        near[rng.randrange(400)] = "é"
        rows.append((200 + i, "  ".join(near)))
    rows += [(300 + i, "de " * (50 + 37 * i)) for i in range(6)] + [(400, "\t\n"), (401, None), (402, " ".join(words(49)))]
    rows += [(500, " ".join(doc[:30] + doc[80:200])), (501, " ".join(passage[:49])), (502, " ".join(passage[:50]))]
    check(make_docs, rows, 50, 6)


def test_edges(make_docs):
    assert substring.remove_repeats(make_docs([])).count() == 0
    text = " ".join(f"x{i}" for i in range(60))
    check(make_docs, [(None, text), (3, text), (5, "a b\x1cc " + text)], 50, 6)
    same = substring.remove_repeats(make_docs([(4, text), (4, text), (9, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in same) == [(4, 0), (4, 0), (9, 60)]
    other = substring.remove_repeats(make_docs([(4, text), (4, "y " + text), (9, text)])).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in other) == [(4, 60, 0), (4, 61, 0), (9, 60, 60)]
    odd = make_docs([(1, text, "en", "s", "k", 1), (2, text, "en", "s", "l", 2)], ", key_text string, starts long")
    assert sorted(r.n_removed for r in substring.remove_repeats(odd).collect()) == [0, 60]


def test_word_hashes_and_sliding_min():
    a, b = word_hashes(b"one two  one\ttwo"), word_hashes("één two".encode())
    assert len(a) == 4 and a[0] == a[2] and a[1] == a[3] == b[1] and a[0] != a[1] and len(word_hashes(b" ")) == 0
    import numpy as np
    v = np.array([5, 3, 9, 1, 7, 7, 2], np.uint64)
    for k in range(1, 8):
        assert sliding_min(v, k).tolist() == [min(v[i:i + k].tolist()) for i in range(len(v) - k + 1)]
