"""Item search against a full dynamic program; planted edits; blocks; edge rows."""

import random

import pytest

from tollgate.llm import decontaminate as D


def distance_in(p, t):
    """Least edit distance of p to any substring of t."""
    prev = list(range(len(p) + 1))
    best = len(p)
    for c in t:
        cur = [0]
        for i, x in enumerate(p, 1):
            cur.append(min(prev[i] + 1, cur[-1] + 1, prev[i - 1] + (x != c)))
        prev = cur
        best = min(best, prev[-1])
    return best


def test_bit_parallel_distance_equals_dynamic_program():
    rng = random.Random(1)
    for _ in range(200):
        p = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 90)))
        t = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 120)))
        assert D.least_distance(D.letters(p), len(p), t, len(p) + 5)[0] == distance_in(p, t)


def planted(rng, items, edits):
    alphabet = "abcdefghij klmno "
    out = []
    for k in range(60):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300)))
        if k % 2:
            item = list(D.normal(items[k % len(items)]))
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(item))
                how = rng.random()
                item[at:at + 1] = [] if how < 0.3 else ["z"] if how < 0.6 else [item[at], "y"]
            text += "".join(item).replace(" ", "\n  ").upper() + text[:50]
        out.append(text)
    return out


@pytest.mark.parametrize("block_chars", [D.BLOCK_CHARS, 100])
def test_documents_equal_full_search(spark, make_docs, block_chars):
    rng = random.Random(7)
    items = ["".join(rng.choice("abcdefghij klmno ") for _ in range(rng.randint(30, 160))).strip() for _ in range(8)]
    texts = planted(rng, items, 8)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = set()
    for i, t in enumerate(texts):
        for k, item in enumerate(items):
            d = distance_in(D.normal(item), D.normal(t))
            if d <= D.budget(len(D.normal(item))):
                want.add((i, k, d))
    docs = make_docs(texts)
    got = D.find_items(docs, bench, block_chars=block_chars).collect()
    assert {(r.doc_id, r.item_id, r.distance) for r in got} == want and len(got) == len(want) > 8
    clean = D.drop_contaminated(docs, bench, block_chars=block_chars)
    assert clean.schema == docs.schema
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {i for i, _, _ in want}


def test_edges(spark, make_docs):
    kind = "item_id long, text string"
    item = "a test item of some length that must not be seen in training"
    bench = spark.createDataFrame([(1, item), (2, None), (3, "short"), (4, ""), (None, item), (1, item)], kind)
    docs = make_docs([(1, f"x {item.upper()} y"), (2, None), (3, ""), (None, item), (5, "short"), (6, "w " * 80_000 + item), (1, f"x {item.upper()} y")])
    got = D.find_items(docs, bench).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=repr) == sorted(
        [(5, 3), *[(d, k) for d in (1, 1, None, 6) for k in (1, 1, None)]], key=repr)
    assert {r.distance for r in got} == {0}
    assert sorted(r.doc_id for r in D.drop_contaminated(docs, bench).collect()) == [2, 3]
    none = spark.createDataFrame([], kind)
    assert D.find_items(docs, none).count() == 0 and D.drop_contaminated(docs, none).count() == docs.count()
    assert D.find_items(make_docs([]), bench).count() == 0 and D.drop_contaminated(make_docs([]), bench).count() == 0
    odd = make_docs([(1, "fine", "en", "s", 3, "t")], ", item_id long, distance string")
    assert D.drop_contaminated(odd, bench).collect() == odd.collect()


@pytest.mark.parametrize("block_chars", [1 << 20, 12])
def test_short_items_are_found_as_whole_words(spark, make_docs, block_chars):
    bench = spark.createDataFrame([(1, "What is  9 x 11?"), (2, "cat"), (3, "a"), (4, "?!"), (5, " ")], "item_id long, text string")
    texts = ["Q: what is 9 x 11? Ninety-nine", "what is 9 x 12?", "concatenate", "the cat, sat", "CAT", "a", "banana", "wow?!", "?x!", "xwhat is 9 x 11?"]
    got = {(r.doc_id, r.item_id, r.distance) for r in D.find_items(make_docs(texts), bench, block_chars=block_chars).collect()}
    assert got == {(0, 1, 0), (3, 2, 0), (4, 2, 0), (5, 3, 0), (7, 4, 0)}
    left = D.drop_contaminated(make_docs(texts), bench, block_chars=block_chars)
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 6, 8, 9]
    if block_chars == 12:                                   # one stage of Python per plan, whatever the number of blocks
        assert left._jdf.queryExecution().toString().count("MapInArrow") <= 1


def test_a_tenth_of_the_characters_may_be_edited(spark, make_docs):
    """The expected budget is fixed here: n // 10 edits, also for short items and those of 24 to 400 characters."""
    rng = random.Random(17)
    letter = lambda: rng.choice("abcdefghij klmno")
    items = [D.normal("x" + "".join(letter() for _ in range(n)) + "x") for n in (20, 24, 30, 45, 81, 120, 240, 394)]
    rows = []
    for item in items:
        n = len(item)
        for edits in (n // 10 - 1, n // 10, n // 10 + 3):
            for spread in (False, True):                    # anywhere, or at even distances
                own = list(item)
                places = [int((e + 0.5) * n / edits) for e in range(edits)] if spread and edits else rng.sample(range(n), edits)
                for at in places:
                    own[at] = "#" if own[at] != " " else "%"
                rows.append("own words " + "".join(own) + " and more of them" + item[:n // 2])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {(i, k, d) for i, t in enumerate(rows) for k, item in enumerate(items)
            if (d := distance_in(item, D.normal(t))) <= len(item) // 10}
    got = {(r.doc_id, r.item_id, r.distance) for r in D.find_items(make_docs(rows), bench).collect()}
    assert got == want
    assert {(k, d) for _, k, d in got} >= {(k, len(item) // 10) for k, item in enumerate(items)}
    assert [D.budget(n) for n in range(5000)] == [0 if n < 20 else n // 10 for n in range(5000)]    # short items: exactly
