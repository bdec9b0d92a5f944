"""Line dedup against a brute-force search for earlier copies of runs."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tollgate.llm import lines


def brute(rows, min_chars):
    """id -> lines that stay: a line goes if a stretch of enough characters around it also begins earlier."""
    first, gone = {}, {}
    docs = sorted(((i, t.split("\n")) for i, t in rows if t is not None), key=lambda r: (r[0] is not None, r[0] or 0))
    for i, ls in docs:
        for p in range(len(ls)):
            chars, end = 0, -1
            for e in range(p, len(ls)):
                chars += len(ls[e]) + 1
                if chars >= min_chars:
                    if first.setdefault(hash(tuple(ls[p:e + 1])), (i, p)) == (i, p):
                        continue
                    end = e
            gone.setdefault(i, set()).update(range(p, end + 1))
    return {i: [x for k, x in enumerate(ls) if k not in gone[i]] for i, ls in docs}


def check(make_docs, rows, min_chars):
    got = lines.without_repeats(make_docs(rows), min_chars=min_chars)
    found = {r.doc_id: r for r in got.collect()}
    for i, kept in brute(rows, min_chars).items():
        assert found[i].text == "\n".join(kept), (i, rows)
        assert found[i].n_chars == len(found[i].text)
    return found


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(["", "a", "bb", "ccc", "dddddd"]), min_size=1, max_size=12), min_size=1, max_size=8),
       st.sampled_from([1, 4, 9, 20]))
def test_random_lines_equal_brute_force(make_docs, docs, min_chars):
    check(make_docs, [(i, "\n".join(d)) for i, d in enumerate(docs)], min_chars)


def test_long_runs_periodic_texts_and_copies(make_docs):
    rng = random.Random(3)
    words = ["alpha", "beta gamma", "delta", "the same line again", ""]
    base = [rng.choice(words) + str(rng.randint(0, 3)) for _ in range(300)]
    rows = [(0, "\n".join(base)), (1, "\n".join(base)), (2, "\n".join(["x"] * 400)), (3, "\n".join(["x"] * 90)),
            (4, "\n".join(base[100:180] + ["own line"] + base[10:40])), (5, "é" * 100 + "\n" + "é" * 100), (6, "")]
    found = check(make_docs, rows, 60)
    assert found[1].text == "" and "own line" in found[4].text


def test_hot_line_over_many_documents(make_docs):
    hot = "a line that a third of all documents begin with, of more than sixty characters"
    rows = [(i, f"{hot}\nown text {i}" if i % 3 else f"other {i} " * 10) for i in range(300)]
    found = check(make_docs, rows, 60)
    assert sum(r.text.startswith(hot) for r in found.values()) == 1


def test_edges(make_docs, spark):
    assert lines.without_repeats(make_docs([])).count() == 0
    assert lines.without_repeats(make_docs([None, None])).filter("text is null").count() == 2
    text = "a repeated document that is longer than sixty characters in its only line"
    same = lines.without_repeats(make_docs([(4, text), (4, text), (7, text)])).collect()
    assert sorted((r.doc_id, r.text) for r in same) == [(4, text), (4, text), (7, "")]
    nulls = lines.without_repeats(make_docs([(None, text), (2, text)])).collect()
    assert {r.doc_id: r.text for r in nulls} == {None: text, 2: ""}
    odd = make_docs([(1, text, "en", "s", "k", 5), (2, text, "en", "s", "l", 6)], ", key_id string, q long")
    got = sorted(tuple(r) for r in lines.without_repeats(odd).collect())
    assert got == [(1, text, "en", "s", len(text), "k", 5), (2, "", "en", "s", 0, "l", 6)]


@pytest.mark.parametrize("n", [1, 3])
def test_no_python_in_the_plan(make_docs, n):
    plan = lines.without_repeats(make_docs(["x" * 80] * n))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
