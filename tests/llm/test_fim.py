import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tollgate.llm import fim


def by_hand(doc_id, text, seed="1"):
    text = text or ""
    n = len(text)
    hexes = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexes[8 * k:8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts():
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh äß好🙂\n") for _ in range(9000))
    made = [None, "", "x", "好", "🙂" * 700, "a" * 50_000, "ab<", "<P", "P>", "<<S>", "< P>", "x<M>y", "<S", "\n\n", "<P" * 2000,
            passage, passage, passage[:4000] + "tail", "head" + passage, "好" * 20_000, "q" * 2047 + "<P>" + "q" * 3000]
    made += ["".join(rng.choice("<PSM> ab好") for _ in range(rng.randint(0, 60))) for _ in range(150)]
    return made


def test_equals_slicing_and_restores(spark, make_docs):
    rows = list(enumerate(texts()))
    docs = make_docs(rows).withColumn("n", F.lit("n")).withColumn("form", F.lit(1)).withColumn("output", F.lit(2)) \
        .withColumn("id", F.lit("clash"))
    made = fim.transform(docs).withColumn("again", fim.restored(F.col("output"), F.col("form"))).collect()
    got = {r.doc_id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made}
    assert got == {i: by_hand(i, t) for i, t in rows}
    assert all(r.again == (rows[r.doc_id][1] or "") for r in made)
    assert {g[1] for g in got.values()} == {"plain", "psm", "spm"}


def test_null_ids_repeated_rows_and_other_seed(spark, make_docs):
    docs = make_docs([(None, "some text"), (7, "one text"), (7, "one text"), (7, "another text")])
    got = sorted((r.n, r.form, r.output) for r in fim.transform(docs, seed="2").collect())
    want = [by_hand(None, "some text", "2"), by_hand(7, "one text", "2"), by_hand(7, "one text", "2"), by_hand(7, "another text", "2")]
    assert got == sorted((w[0], w[1], w[4]) for w in want)


def test_empty_table(make_docs):
    made = fim.transform(make_docs([(1, "x")]).filter("doc_id < 0"))
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"] and made.count() == 0


def test_chunks_depend_on_content_only():
    rng = random.Random(5)
    passage = bytes(rng.randrange(256) for _ in range(20_000))
    a, b = fim.chunks(b"one beginning " + passage), fim.chunks(b"quite another beginning, longer " + passage)
    assert b"".join(a).endswith(passage) and len(set(a) & set(b)) >= len(a) - 3
    assert max(map(len, fim.chunks(b"a" * 100_000))) <= fim.MAX_CHUNK
    assert b"".join(fim.chunks(b"a" * 100_000)) == b"a" * 100_000 and fim.chunks(b"") == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("<PSM> aé好", max_size=6), max_size=7), st.integers(0, 7))
def test_summaries_combine_in_any_grouping(parts, k):
    each = [fim.summary(p.encode()) for p in parts]

    def fold(xs):
        whole = fim.EMPTY
        for x in xs:
            whole = fim.combine(whole, x)
        return whole
    assert fim.combine(fold(each[:k]), fold(each[k:])) == fold(each) == fim.summary("".join(parts).encode())


def test_marks_across_chunk_borders(monkeypatch):
    monkeypatch.setattr(fim, "chunks", lambda data: [data[k:k + 1] for k in range(len(data))])
    cache = fim.Cache()
    for text in ("ab<P>cd", "<M>", "é<S>", "<P", "<好P>"):
        t = fim.Text(text.encode(), cache)
        assert (t.n, t.marked) == (len(text), any(m in text for m in ("<P>", "<S>", "<M>")))
        assert [t.byte_at(k) for k in range(t.n + 1)] == [len(text[:k].encode()) for k in range(t.n + 1)]


def test_cache_is_verified_and_bounded():
    cache = fim.Cache(limit=3000)
    for k in range(100):
        cache.summary(b"%d" % k * 300)
    assert cache.held <= 3000 + 1000 and cache.hits == 0
    assert cache.summary(b"99" * 300) == fim.summary(b"99" * 300) and cache.hits == 1
    assert cache.held == sum(len(c) + 200 for c in cache.known)


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 5000])
def test_rolling_hash_sees_its_window_only(n):
    rng = random.Random(n)
    data = bytes(rng.randrange(256) for _ in range(n))
    h = fim.rolling(data)
    for i in range(0, n, 97):
        own = data[max(0, i - fim.WINDOW + 1):i + 1]
        assert int(h[i]) == sum(int(fim._GEAR[b]) << (len(own) - 1 - j) for j, b in enumerate(own)) & 0xFFFFFFFF
