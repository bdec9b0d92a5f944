"""Token counts by a tokenizer compiled into two transducers.

A byte-level BPE tokenizer cuts a text into words by a pattern and merges the bytes of each word by rank. Both
steps are compiled into deterministic transducers, and their cascade counts the tokens; no token is formed.

* The *word transducer* reads classes of characters. It has nine states, and a transition is annotated with the
  cuts it brings: before the character read and, where the pattern looks ahead (a space goes with the word that
  follows, ``'re`` is a word but ``'ra`` is not), before the one before it. Texts are laid end to end and cut into
  chunks of ``CHUNK`` characters at any place. A chunk's state map (state on entry -> state on exit) is computed for all
  chunks at once; maps compose associatively, so a parallel prefix scan (doubling) over the chunks' maps gives
  every chunk its state on entry, and one more pass reads off the cuts.
* The *token transducer* reads the bytes of a word. A transition is annotated with the change of the number of
  tokens. It rests on two facts of BPE by ranked merges: each prefix of a word has one last token, and a sequence
  of tokens is the tokenizer's own exactly if each two neighbours are. A state is what the past still
  bears on: the places at which a token could have begun that is not yet complete, with the last token before each
  and the tokens counted there. Reading a byte completes the one token whose neighbour fits, and its
  annotation is one more than the count where that token began. States are built when first reached and
  interned; at ``STATES`` states a worker starts anew, as automata built on demand do, at no cost but time.
  A Python worker keeps what it has built from task to task.

The vocabulary is read on the driver and shipped as it is: its size is fixed, and its file need not be seen by executors.
Long texts are read in segments: after a cut the word transducer is in its first state, so a segment
ends at its last cut and the next one begins there. Memory is a small multiple of a segment, or of a longer word.

Defined results: null and empty texts have no bytes and no tokens; a special string inside a text is one token and
separates words, as is the library's default; rows with equal ids are counted each; an empty table
gives no rows; texts of any length are counted whole; only the id and the text column are read.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import kept_by_worker, ship

# ---- words ------------------------------------------------------------------------------------

# Classes of characters. END stands between texts and for special strings; SINGLE, R_OR_V, L and E are
# the letters of the contractions 's 't 'm 'd, 're 've, 'll.
END, SPACE, WHITE, APOSTROPHE, SINGLE, R_OR_V, L, E, LETTER, NUMBER, OTHER = range(11)
# States: what the word so far consists of. AFTER_SPACE and AFTER_WHITE: white space whose last character is that.
START, LETTERS, NUMBERS, OTHERS, AFTER_SPACE, AFTER_WHITE, QUOTE, QUOTE_RV, QUOTE_L = range(9)
N_STATES = 9
HERE, BACK = 1, 2                      # cut before this character; before the one before it
_LETTERS = (SINGLE, R_OR_V, L, E, LETTER)
CHUNK = 64
HEAD = 8
SEGMENT = 1 << 20
BETWEEN, SPECIAL = "\ud800", "\ud801"  # lone surrogates: no text holds them


def begun(c: int) -> int:
    """The state after a word's first character."""
    return (LETTERS if c in _LETTERS else
            {NUMBER: NUMBERS, OTHER: OTHERS, APOSTROPHE: QUOTE, SPACE: AFTER_SPACE, WHITE: AFTER_WHITE}.get(c, START))


def step(state: int, c: int) -> tuple[int, int]:
    """(next state, cuts) of the word pattern."""
    if state in (QUOTE_RV, QUOTE_L):
        if c == (E if state == QUOTE_RV else L):
            return START, 0
        after, cuts = step(LETTERS, c)                     # no contraction: the letter begins a word
        return after, cuts | BACK
    if c == END or state == START:
        return begun(c), HERE
    if state == QUOTE and c in (SINGLE, R_OR_V, L):
        return {SINGLE: START, R_OR_V: QUOTE_RV, L: QUOTE_L}[c], 0
    if state in (AFTER_SPACE, AFTER_WHITE):
        if c in (SPACE, WHITE):
            return begun(c), 0
        if state == AFTER_WHITE:
            return begun(c), HERE | BACK
        return (OTHERS if c == APOSTROPHE else begun(c)), BACK
    if state in (OTHERS, QUOTE) and c in (OTHER, APOSTROPHE):
        return OTHERS, 0
    if (state == LETTERS and c in _LETTERS) or (state == NUMBERS and c == NUMBER):
        return state, 0
    return begun(c), HERE


# By 16 * state + class, so that an index stays within a byte.
NEXT, CUTS = np.zeros(16 * N_STATES, np.uint8), np.zeros(16 * N_STATES, np.uint8)
for _s in range(N_STATES):
    for _c in range(OTHER + 1):
        NEXT[16 * _s + _c], CUTS[16 * _s + _c] = step(_s, _c)


def character_classes(splitter) -> np.ndarray:
    """Class of every code point, as the library's own splitter (of one Unicode version) has it.

    All code points in order are split once: a piece holds points of one class, which its first one tells.
    """
    def kind(ch: str) -> int:
        joins = [cls for seen, cls in (("a", LETTER), ("1", NUMBER), ("$", OTHER)) if len(splitter.pre_tokenize_str(seen + ch)) == 1]
        return joins[0] if joins else WHITE

    table = np.full(0x110000, END, np.uint8)               # surrogates are in no text
    table[:128] = [kind(chr(c)) for c in range(128)]
    points = [*range(128, 0xD800), *range(0xE000, 0x110000)]
    text = "".join(map(chr, points))
    for _, (start, end) in splitter.pre_tokenize_str(text):
        table[points[start]:points[end - 1] + 1] = kind(text[start])
    table[0xD800:0xE000] = END
    for chars, cls in ((" ", SPACE), ("'", APOSTROPHE), ("stmd", SINGLE), ("rv", R_OR_V), ("l", L), ("e", E)):
        for ch in chars:
            table[ord(ch)] = cls
    return table


def chunk_maps(chunked: np.ndarray) -> np.ndarray:
    """State on exit by state on entry, (N_STATES, chunks), for classes laid out as (CHUNK, chunks)."""
    maps = np.repeat(np.arange(N_STATES, dtype=np.uint8)[:, None], chunked.shape[1], axis=1)
    for row in chunked[:HEAD]:
        maps = NEXT[maps << 4 | row]
    agree = (maps == maps[0]).all(axis=0)                  # most chunks forget how they were entered
    one, several = maps[0], maps[:, ~agree]
    rest = chunked[:, ~agree]
    for row, few in zip(chunked[HEAD:], rest[HEAD:]):
        one = NEXT[one << 4 | row]
        several = NEXT[several << 4 | few]
    maps[:] = one
    maps[:, ~agree] = several
    return maps


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """Composition of every chunk's map with those of all chunks before it, by doubling."""
    reach = 1
    while reach < maps.shape[1]:
        composed = maps.copy()
        composed[:, reach:] = np.take_along_axis(maps[:, reach:], maps[:, :-reach], axis=0)
        maps, reach = composed, 2 * reach
    return maps


def word_starts(classes: np.ndarray) -> np.ndarray:
    """Places of the cuts in a sequence of classes that begins with a word's first character."""
    n = len(classes)
    padded = np.full(-(-n // CHUNK) * CHUNK, END, np.uint8)
    padded[:n] = classes
    chunked = np.ascontiguousarray(padded.reshape(-1, CHUNK).T)
    state = np.concatenate((np.array([START], np.uint8), prefix_scan(chunk_maps(chunked))[START, :-1]))
    cuts = np.empty_like(chunked)
    for k, row in enumerate(chunked):
        at = state << 4 | row
        cuts[k], state = CUTS[at], NEXT[at]
    cuts = cuts.T.reshape(-1)[:n]                          # the padding brings no cuts
    starts = cuts & HERE
    starts[:-1] |= cuts[1:] >> 1
    return np.flatnonzero(starts)


# ---- tokens of a word ---------------------------------------------------------------------------

STATES = 150_000
WORDS = 400_000
NO_TOKEN = -1
MEANING = -1


class TokenTransducer:
    """Counts the tokens of words; transitions are built when first taken.

    A state is the dictionary of its transitions (byte -> next state, change of the number of tokens),
    with what it stands for under ``MEANING``.
    """

    def __init__(self, vocabulary: list[bytes], merges: list[tuple[int, int, int]]):
        self.number = {t: i for i, t in enumerate(vocabulary)}
        self.rank = {(a, b): r for r, (a, b, _) in enumerate(merges)}
        self.made = [-1] * len(vocabulary)                 # rank of the merge that makes a token; bytes: none
        self.halves = [(t, t) for t in range(len(vocabulary))]
        for r, (a, b, c) in enumerate(merges):
            self.made[c], self.halves[c] = r, (a, b)
        self.open = {t[:k] for t in vocabulary for k in range(1, len(t))}     # beginnings of longer tokens
        self.forget()

    def forget(self) -> None:
        self.states: dict[tuple, dict] = {}
        self.first = self.intern((b"", ((0, NO_TOKEN, 0),)))

    def intern(self, meaning: tuple) -> dict:
        return self.states.setdefault(meaning, {MEANING: meaning})

    def neighbours(self, a: int, b: int) -> bool:
        """Whether the tokenizer may give ``b`` right after ``a`` (or first, after ``NO_TOKEN``).

        The younger of the two tokens is taken apart, again and again: they are kept apart unless, before the
        last merge undone, the two parts at the border would have merged (on equal rank the left pair goes first).
        """
        if a == NO_TOKEN:
            left, right = self.halves[b]
            return left == right == b or self.neighbours_within(left, right, self.made[b])
        return self.neighbours_within(a, b, len(self.rank))

    def neighbours_within(self, a: int, b: int, until: int) -> bool:
        made, halves = self.made, self.halves
        while True:
            if self.rank.get((a, b), until) < until:
                return False
            if made[a] > made[b]:
                until, a = made[a], halves[a][1]
            elif made[b] >= 0:
                until, b = made[b] + 1, halves[b][0]
            else:
                return True

    def move(self, state: dict, byte: int) -> tuple[dict, int]:
        """(next state, change of the number of tokens), built from the state's open places.

        A state stands for the bytes from its first open place on and, for each open place, its offset in
        them, the last token before it and the tokens up to it, less those up to now.
        """
        tail, places = state[MEANING]
        tail += bytes((byte,))
        still = []
        last = change = None
        for at, before, count in places:
            word = tail[at:]
            if change is None:
                token = self.number.get(word)
                if token is not None and self.neighbours(before, token):
                    last, change = token, count + 1
            if word in self.open:
                still.append((at, before, count))
        still.append((len(tail), last, change))
        cut = still[0][0]
        after = self.intern((tail[cut:], tuple([(at - cut, before, count - change) for at, before, count in still])))
        state[byte] = after, change
        return state[byte]

    def count(self, word: bytes) -> int:
        if len(self.states) > STATES:
            self.forget()
        state, n = self.first, 0
        for byte in word:
            move = state.get(byte)
            if move is None:
                if len(self.states) > 2 * STATES:          # within one very long word
                    meaning = state[MEANING]
                    self.forget()
                    state = self.intern(meaning)
                move = self.move(state, byte)
            state, change = move
            n += change
        return n


class Tokenizer:
    """The compiled cascade, as shipped to tasks; what tasks build on demand stays with them."""

    def __init__(self, vocabulary: list[bytes], merges: list[tuple[int, int, int]], specials: list[str], classes: np.ndarray):
        self.vocabulary, self.merges, self.specials = vocabulary, merges, specials
        self.class_from = np.flatnonzero(np.diff(classes, prepend=255))
        self.class_of = classes[self.class_from]           # shipped as runs
        parts = (*vocabulary, *merges, *specials)
        self.key = hashlib.sha256(repr((parts, self.class_from.tolist(), self.class_of.tolist())).encode()).hexdigest()

    def open(self) -> Tokenizer:
        """Set up what a task works with."""
        self.classes = np.repeat(self.class_of, np.diff(self.class_from, append=0x110000))
        self.tokens = TokenTransducer(self.vocabulary, self.merges)
        self.known: dict[str, int] = {}
        self.special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        return self

    def tokens_of(self, words: list[str]) -> np.ndarray:
        """Tokens of each word; words met before are not read again."""
        if len(self.known) > WORDS:
            self.known.clear()
        known = self.known
        count = self.tokens.count
        for w in set(words).difference(known):
            known[w] = count(w.encode())
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def marked(self, text: str) -> str:
        return self.special.sub(SPECIAL, text) if self.special else text

    def count_segment(self, text: str, whole: bool) -> tuple[np.ndarray, np.ndarray, int]:
        """(starts of words or marks, their tokens, end): of an unfinished text up to its last cut."""
        classes = self.classes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        starts = word_starts(np.append(classes, np.uint8(END)) if whole else classes)
        ends = starts[1:]
        starts = starts[:-1]
        words = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        real = classes[starts] != END
        tokens = np.zeros(len(starts), np.int64)
        tokens[real] = self.tokens_of([w for w, r in zip(words, real.tolist()) if r])
        tokens[~real] = [w == SPECIAL for w in words if w in (SPECIAL, BETWEEN)]
        return starts, tokens, int(ends[-1]) if len(ends) else 0

    def count_long(self, text: str) -> int:
        """Tokens of one text, in segments that end at a cut."""
        text, at, size, n = self.marked(text), 0, SEGMENT, 0
        while at < len(text):
            whole = at + size >= len(text)
            _, tokens, end = self.count_segment(text[at:at + size], whole)
            if whole:
                return n + int(tokens.sum())
            n += int(tokens.sum())
            at, size = at + end, SEGMENT if end else 2 * size  # a word longer than the segment: try a longer one
        return n

    def count_all(self, texts: list[str]) -> list[int]:
        """Tokens of each of some short texts, laid end to end."""
        laid = "".join([self.marked(t) + BETWEEN for t in texts])
        if not texts:
            return []
        starts, tokens, _ = self.count_segment(laid, True)
        ends = np.flatnonzero(np.frombuffer(laid.encode("utf-32-le", "surrogatepass"), np.uint32) == ord(BETWEEN))
        total = np.concatenate(([0], np.cumsum(tokens)))[np.searchsorted(starts, ends)]
        return np.diff(total, prepend=0).tolist()


def compiled(path: str) -> Tokenizer:
    """Compile a tokenizer file of byte-level BPE with the pattern the word transducer is made for."""
    from tokenizers.pre_tokenizers import ByteLevel        # on the driver only
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
           if model.get(k)]
    if (model["type"] != "BPE" or odd or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True)
            or pre.get("add_prefix_space") or spec["normalizer"]):
        raise ValueError(f"not plain byte-level BPE: {path}")
    added = spec["added_tokens"]
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
        raise ValueError(f"special strings that take white space or word borders into account: {path}")
    # the file writes each byte as a printable character: itself, or the next free one from 256 on
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(hidden)}
    written = [t for t, _ in sorted(model["vocab"].items(), key=lambda x: x[1])]
    number = {t: i for i, t in enumerate(written)}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return Tokenizer([bytes(byte_of[c] for c in t) for t in written],
                     [(number[a], number[b], number[a + b]) for a, b in pairs], [t["content"] for t in added],
                     character_classes(ByteLevel(add_prefix_space=False)))


_SCHEMA = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def _counter(tokenizer: Tokenizer):
    def count(batches):
        work = kept_by_worker("token_counts", tokenizer.key, tokenizer.open)
        for batch in batches:
            ids, n_bytes, n_tokens, group, at, size = batch.column(0), [], [], [], [], 0
            for k, scalar in enumerate(batch.column(1)):
                text = scalar.as_py() or ""
                n_bytes.append(len(text.encode()))
                n_tokens.append(0)
                if len(text) > SEGMENT:
                    n_tokens[k] = work.count_long(text)
                else:
                    group.append(text)
                    at.append(k)
                    size += len(text) + 1
                if size > SEGMENT or k + 1 == batch.num_rows:
                    for i, n in zip(at, work.count_all(group)):
                        n_tokens[i] = n
                    group, at, size = [], [], 0
            yield pa.RecordBatch.from_arrays([ids, pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], schema=_SCHEMA)
    return count


def count_tokens(docs: DataFrame, tokenizer: Tokenizer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, n_bytes, n_tokens`` of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_counter(tokenizer), "id long, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)


ship(__name__)
