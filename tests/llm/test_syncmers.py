"""Closed syncmers against their definition; fingerprints of edited texts; order of documents."""

import hashlib
import random

import numpy as np
import pytest

from tollgate.llm import syncmers as S


def definition(data):
    """Places of the K-byte substrings whose least S-byte substring (by the same hash) lies first or last."""
    def h(b):
        x = int.from_bytes(b, "little") * 0x9E3779B97F4A7C15 % (1 << 64)
        return x ^ x >> 32
    out = []
    for i in range(len(data) - S.K + 1):
        inner = [h(data[i + j:i + j + S.S]) for j in range(S.K - S.S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(i)
    return out


def test_anchors_by_definition_and_without_context():
    rng = random.Random(3)
    data = bytes(rng.choice(b"abcde \xc3\xa9") for _ in range(600))
    places, hashes = S.anchors(data)
    assert places.tolist() == definition(data)
    part, part_hashes = S.anchors(data[100:300])
    inside = (places >= 100) & (places <= 300 - S.K)
    assert (part + 100).tolist() == places[inside].tolist() and part_hashes.tolist() == hashes[inside].tolist()


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(t) // 4
        new = t[:len(t) - cut] + following[:cut]
        a, b, c = (S.sketch(*S.anchors(x.encode())) for x in (t, new, following))
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), S.digits(a), S.digits(b), S.likeness(a, b), S.likeness(a, c)))
    return sorted(out, key=repr)


def test_along_the_order_of_documents(make_docs):
    rng = random.Random(5)
    rows = [(i * 3, "".join(rng.choice("abcdéß 𝄞 efg") for _ in range(rng.choice([0, 3, 15, 16, 17, 70, 400, 3000])))) for i in range(120)]
    rows += [(1, None), (None, "first of all, because its id is null"), (500, "x" * 200_000)]
    rng.shuffle(rows)
    got = S.with_next(make_docs(rows).repartition(7))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_likeness_follows_the_share_of_text():
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh ") for _ in range(6000))
    other = "".join(rng.choice("ijklmnop ") for _ in range(6000))
    of = lambda t: S.sketch(*S.anchors(t.encode()))
    assert S.likeness(of(text), of(text)) == 1 and S.likeness(of(text), of(other)) == 0
    for share in (0.25, 0.5, 0.75, 0.9):
        n = int(6000 * share)
        assert S.likeness(of(text), of(text[:n] + other[n:])) == pytest.approx(share, abs=0.2)
    assert np.array_equal(S.slots_of(S.digits(of(text))), of(text))
    assert S.likeness(of(""), of("")) == 1 and S.likeness(of(""), of("abc")) == 0 and S.likeness(of("abc"), of("abc")) == 1


def test_edges(make_docs):
    assert S.with_next(make_docs([])).count() == 0
    one = S.with_next(make_docs([(4, "abcdefgh" * 10)])).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(("abcdefgh" * 7 + "abcd" + "abcdefghabcdefghabcd").encode()).hexdigest()
    twice = S.with_next(make_docs([(4, "same text here, long enough"), (4, "same text here, long enough")])).collect()
    assert [r.near_next for r in twice] == [1.0, 1.0] and len({r.fingerprint for r in twice}) == 1
    odd = make_docs([(1, "a", "en", "s", 5, "x")], ", part long, edge string")
    assert S.with_next(odd).first().n_chars == 1


def test_likeness_of_texts_with_something_inserted():
    rng = random.Random(11)
    text = "".join(rng.choice("abcdefgh ") for _ in range(6000))
    new = "".join(rng.choice("ijklmnop ") for _ in range(900))
    of = lambda t: S.sketch(*S.anchors(t.encode()))
    for changed in (new[:80] + text, new + text, text[:3000] + new + text[3000:], text[500:],
                    new[:300] + text[:2000] + new[300:600] + text[2000:4000] + new[600:] + text[4000:]):
        for pair in ((text, changed), (changed, text)):
            assert S.likeness(*map(of, pair)) == pytest.approx(min(map(len, pair)) / max(map(len, pair)), abs=0.15)


def test_places_beyond_a_megabyte_and_texts_without_syncmers():
    rng = random.Random(12)
    hashes = np.array([rng.getrandbits(64) for _ in range(64)], np.uint64)
    places = np.arange(64) * 3_000_000
    slots = S.sketch(places, hashes)
    assert np.array_equal(S.slots_of(S.digits(slots)), slots)
    full = slots != S.EMPTY
    assert sorted(set((slots[full] & np.uint64(0xFFFFFFFF)).tolist())) == sorted(set((slots[full] & np.uint64(0xFFFFFFFF)).tolist()) & set((places // S.UNIT).tolist()))
    assert S.likeness(slots, S.sketch(places[::-1], hashes)) < 0.2
    without = [t for t in ("".join(rng.choice("abcdef") for _ in range(rng.randint(16, 22))) for _ in range(400)) if not definition(t.encode())]
    assert len(without) > 5
    for t in without:
        one = S.sketch(*S.anchors(t.encode()))
        assert (one != S.EMPTY).sum() == 1 and S.likeness(one, one) == 1 and S.likeness(one, S.sketch(*S.anchors(b""))) == 0
