import json
import random
import re

import numpy as np
import pytest

from tollgate.llm import token_counts as T

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [" ", "  ", "\n", "\t", "'", "s", "t", "re", "ve", "ll", "d", "m", "a", "the", "ing", " the", "é", "ß", "你好", "1", "23", "½", "²",
         "!", "...", "'s", "'re", "'l", "'r", "<|endoftext|>", "<|endof", " ", "　", "🙂", "́", "aaaa", "\r\n", "E", "'S"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def compiled():
    return T.compiled(PATH).open()


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(1)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    made += ["a" * 3000, "'" * 333, " " * 777, "\n" * 50, "ab" * 2000, "'s" * 400, "x'r", "x'l", "'v", "",
             "".join(rng.choice("abcdefghijklmnop") for _ in range(3000)), "".join(chr(rng.randint(1, 0x2FFF)) for _ in range(3000)),
             "<|endoftext|>" * 3, "a<|endoftext|>", " <|endoftext|> ", "\x00\x1f", "\U0010ffff"]
    return made


def counts(library, texts):
    return [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_odd_texts_equal_the_library(library, compiled, odd_texts):
    assert compiled.count_all(odd_texts) == counts(library, odd_texts)


@pytest.mark.parametrize("segment", [7, 50, 1000])
def test_segments_of_long_texts(library, compiled, odd_texts, monkeypatch, segment):
    monkeypatch.setattr(T, "SEGMENT", segment)
    some = odd_texts[::7] + odd_texts[-17:]
    assert [compiled.count_long(t) for t in some] == counts(library, some)


def test_forgetting_states_changes_nothing(library, odd_texts, monkeypatch):
    monkeypatch.setattr(T, "STATES", 50)
    monkeypatch.setattr(T, "WORDS", 20)
    some = odd_texts[:400] + odd_texts[-17:]
    assert T.compiled(PATH).open().count_all(some) == counts(library, some)


def test_words_by_the_pattern(compiled):
    """Cuts of the word transducer against the pattern, for ASCII where ``re`` knows the classes."""
    pattern = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+")
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice(" \n'strvledmx1!") for _ in range(rng.randint(1, 200)))
        classes = compiled.classes[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        assert T.word_starts(np.append(classes, np.uint8(T.END)))[:-1].tolist() == [m.start() for m in pattern.finditer(text)]


def test_state_maps_compose_in_any_grouping():
    rng = np.random.Generator(np.random.PCG64(4))
    classes = rng.integers(0, T.OTHER + 1, (T.CHUNK, 37)).astype(np.uint8)
    scanned = T.prefix_scan(T.chunk_maps(classes))
    for start in range(T.N_STATES):
        state = start
        for k in range(37):
            for c in classes[:, k]:
                state = int(T.NEXT[16 * state + c])
            assert scanned[start, k] == state


def test_neighbours_as_merged_by_definition(compiled):
    """Pairs of tokens taken apart against merging by rank, leftmost first."""
    t = compiled.tokens
    vocabulary = compiled.vocabulary

    def merged(word):
        parts = [t.number[bytes([b])] for b in word]
        while known := [(t.rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in t.rank]:
            i = min(known)[1]
            parts[i:i + 2] = [t.number[vocabulary[parts[i]] + vocabulary[parts[i + 1]]]]
        return parts
    rng = random.Random(6)
    short = [i for i, v in enumerate(vocabulary) if len(v) <= 3]
    for _ in range(4000):
        a, b = rng.choice(short), rng.choice(short if rng.random() < 0.5 else range(len(vocabulary)))
        assert t.neighbours(a, b) == (merged(vocabulary[a] + vocabulary[b]) == [a, b])
        assert t.neighbours(T.NO_TOKEN, b) == (merged(vocabulary[b]) == [b])


def test_classes_are_the_library_s(compiled):
    split = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    rng = random.Random(7)
    for c in [*range(0x3100), *rng.sample(range(0xE000, 0x110000), 3000)]:
        joins = [len(split(x + chr(c))) == 1 for x in "a1$"]
        own = {T.NUMBER: 1, T.OTHER: 2, T.APOSTROPHE: 2, T.SPACE: 3, T.WHITE: 3}.get(int(compiled.classes[c]), 0)
        assert (joins.index(True) if any(joins) else 3) == own, hex(c)


def test_rows(spark, make_docs, library):
    texts = [None, "", "Hello world", "Hello world", "tab\there <|endoftext|> x", "好" * 40, "word " * 3000]
    docs = make_docs([*enumerate(texts), (2, "again"), (None, "no id")]).selectExpr("*", "'x' AS id", "1 AS n_tokens", "2 AS n_bytes")
    tokenizer = T.compiled(PATH)
    got = T.count_tokens(docs, tokenizer)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    want = [(i, len((t or "").encode()), counts(library, [t or ""])[0]) for i, t in [*enumerate(texts), (2, "again"), (None, "no id")]]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert T.count_tokens(docs.filter("doc_id < -1"), tokenizer).count() == 0


def test_other_tokenizers_are_refused(tmp_path):
    spec = json.load(open(PATH, encoding="utf-8"))
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}},
                   {"added_tokens": [{"content": "x", "lstrip": True, "rstrip": False, "single_word": False}]}):
        path = tmp_path / "t.json"
        path.write_text(json.dumps({**spec, **change}))
        with pytest.raises(ValueError):
            T.compiled(str(path))
