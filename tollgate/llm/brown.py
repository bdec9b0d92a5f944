"""Class-based n-gram scores: exchange clustering and class bigrams over all training texts.

P(w | v) = P(class(w) | class(v)) * P(w | class(w)). In passes over the texts:

1. counts of all tokens of all training texts (a dictionary per task, summed by Spark);
2. training texts as numbers of words, written once: the rank of one of the ``FREQUENT`` most frequent words (of at
   most ``WORD_BYTES`` bytes), or the group of all other words with the same hash of their last two bytes
   (``TAIL_GROUPS``), so every token has one;
3. first classes: exchange clustering on the driver over the pairs of ``FIRST`` words and the groups, a matrix of fixed size.
   Symbols move between ``CLASSES`` classes while the likelihood of the class bigrams rises;
4. exchange over all words with ``EVIDENCE`` occurrences or more, ``SWEEPS`` times: Spark counts every word's neighbours
   by class, and tasks that hold the table of class bigrams only move each word to the class in which its
   neighbours are most likely. What comes back is one class per frequent word;
5. the class bigrams of these classes, and scores. Counts and classes of the frequent words go to
   the tasks; all other words of a text meet the table of counts in a join, by word. Words that fill a
   third of all tokens are thus never shuffled per token, and no table that grows is broadcast.

Emission: P(w | class) = (count(w) + 0.1) / mass(class), where the mass has 0.1 more per known
word and, in classes with a tail group, 0.1 for a word not seen. Transition: Witten-Bell
interpolation of class bigrams with the classes' masses.

Defined results: null and empty texts are one end token; texts of any length are learned and scored whole; without
training texts all tokens have the same probability, 1; of equally frequent words the lesser bytes come first, of equally
good classes a word keeps its own, else takes the first; rows with a null id are scored, not learned from; repeated
rows count as often as they come; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import ship, write_table

SMOOTH = 0.1
CLASSES = 64
FIRST = 1024
TAIL_GROUPS = 32
FREQUENT = 1 << 18
EVIDENCE = 10
DENSE = 1 << 13            # words whose contexts a task counts in an array
WORD_BYTES = 64
FIRST_SWEEPS = 8
SWEEPS = 2
FLUSH = 400_000            # words held by a task before they are passed on
END = b""                  # no word is empty


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def tail_group(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAIL_GROUPS


def tail_group_column(word: Column) -> Column:
    return F.crc32(F.substring(word, -2, 2)) % TAIL_GROUPS


def count_tokens(texts: DataFrame) -> DataFrame:
    """(word, n) over a column ``text``; the end token is the empty word."""
    def run(batches):
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                held.update(words_of(text.as_py()))
                if len(held) >= FLUSH:
                    yield out()
                    held.clear()
            held[END] += batch.num_rows
        if held:
            yield out()

    rows = texts.select(F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(vocabulary: DataFrame, limit: int):
    """At most ``limit`` words with their counts, as an Arrow table, the most frequent first.

    A histogram of the counts (eight steps for each doubling) tells the least count that no more
    than ``limit`` words reach, so only these rows leave the executors.
    """
    step = F.floor(F.log2("n") * 8)
    sizes = sorted(((r.s, r.c) for r in vocabulary.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("c")).collect()), reverse=True)
    least, words = None, 0
    for s, c in sizes:
        words += c
        if words > limit:
            break
        least = s
    top = vocabulary.filter(step >= least if least is not None else F.lit(False)).toArrow()
    return top.sort_by([("n", "descending"), ("word", "ascending")])


def write_ranks(texts: DataFrame, words: list[bytes]) -> DataFrame:
    """Each text as an array of the ranks of its words; a word without a rank is -1 - its tail group."""
    def run(batches):
        rank = {w: i for i, w in enumerate(words)}
        get = rank.get
        for batch in batches:
            out, held = [], 0
            for text in batch.column(0):
                own = words_of(text.as_py())
                ranks = np.fromiter((get(w, -TAIL_GROUPS - 1) for w in own), np.int32, len(own))
                at = np.flatnonzero(ranks < -TAIL_GROUPS)
                ranks[at] = [-1 - tail_group(own[i]) for i in at]
                out.append(ranks)
                held += len(ranks)
                if held > FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int32()))], ["ranks"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int32()))], ["ranks"])

    rows = texts.select(F.col("text").cast("string").cast("binary").alias("text"))
    return write_table(rows.mapInArrow(run, "ranks array<int>"), "ranks")


def laid_out(column: pa.ListArray, numbers: np.ndarray, end: int) -> np.ndarray:
    """Texts end to end, each followed by ``end``; a word's number is at its rank, a tail group's at the back."""
    flat, lengths = column.flatten().to_numpy(), column.value_lengths().to_numpy()
    out = np.full(len(flat) + len(lengths), end, np.int64)
    out[np.arange(len(flat)) + np.repeat(np.arange(len(lengths)), lengths)] = numbers[flat]
    return out


def numbers_of(of_rank: np.ndarray, of_tail: np.ndarray) -> np.ndarray:
    """Lookup by rank, and by -1 - tail group as an index from the back."""
    return np.concatenate((of_rank, of_tail[::-1]))


def count_pairs(ranks: DataFrame, numbers: np.ndarray, end: int, size: int) -> np.ndarray:
    """Pairs of neighbouring numbers (below ``size``); a text begins after an end token."""
    def run(batches):
        total, last = np.zeros(size ** 2, np.int64), end
        for batch in batches:
            now = laid_out(batch.column(0), numbers, end)
            total += np.bincount(np.append(last, now[:-1]) * size + now, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    got = ranks.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros(size ** 2)
    pairs[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    return pairs.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, fixed: int, classes: int = CLASSES, sweeps: int = FIRST_SWEEPS) -> np.ndarray:
    """Class of each symbol: symbols move, one at a time, to the class that raises the class
    bigrams' likelihood most, until none moves. ``fixed`` stays alone in the last class.
    """
    n = len(pairs)
    k = max(2, min(classes, n))
    order = np.argsort(-pairs.sum(axis=0), kind="stable")
    order = order[order != fixed]
    of = np.empty(n, np.int64)
    of[order] = np.arange(len(order)) % (k - 1)
    of[fixed] = k - 1
    member = np.zeros((n, k))
    member[np.arange(n), of] = 1
    to, come = pairs @ member, pairs.T @ member             # symbol x class: followers, predecessors
    table = member.T @ to
    for _ in range(sweeps):
        moved = 0
        for s in order:
            own, a = pairs[s, s], of[s]
            r, left = to[s].copy(), come[s].copy()
            r[a] -= own
            left[a] -= own
            if not r.any() and not left.any():
                continue
            table[a] -= r                                    # the symbol leaves its class
            table[:, a] -= left
            table[a, a] -= own
            out, into = table.sum(axis=1) + left, table.sum(axis=0) + r     # whatever class it goes to
            gain = (_xlogx(table + r) - _xlogx(table)).sum(axis=1) + (_xlogx(table.T + left) - _xlogx(table.T)).sum(axis=1)
            d = np.diagonal(table)
            gain += _xlogx(d + r + left + own) + _xlogx(d) - _xlogx(d + r) - _xlogx(d + left)
            for side, size in ((out, r.sum() + own), (into, left.sum() + own)):
                gain -= _xlogx(side + size) - _xlogx(side)
            gain[k - 1] = -np.inf
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            table[b] += r
            table[:, b] += left
            table[b, b] += own
            if b != a:
                moved += 1
                of[s] = b
                to[:, a] -= pairs[:, s]
                to[:, b] += pairs[:, s]
                come[:, a] -= pairs[s]
                come[:, b] += pairs[s]
        if not moved:
            break
    return of


def count_contexts(ranks: DataFrame, classes: Classes, movable: int) -> DataFrame:
    """(key, n): how often a word of rank below ``movable`` has a neighbour of a class, and the class bigrams.

    key = (2 * rank + side) * ``CLASSES`` + class, side 1 for the word after; below zero -1 - (class * CLASSES + class after).
    """
    numbers, own = classes.numbers, np.int64(len(classes.of_rank))

    def run(batches):
        table, held, size = np.zeros(CLASSES ** 2, np.int64), [], 0

        def out(keys: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(list(map(pa.array, np.unique(np.concatenate(keys), return_counts=True))), ["key", "n"])

        dense = np.zeros(2 * CLASSES * DENSE, np.int64)    # of the most frequent words; the others' keys are sorted
        for batch in batches:
            ids = laid_out(batch.column(0), np.append(np.arange(own), np.full(TAIL_GROUPS, own)), int(own))
            now = laid_out(batch.column(0), numbers, classes.end)
            before = np.append(np.int64(classes.end), now[:-1])
            table += np.bincount(before * CLASSES + now, minlength=CLASSES ** 2)
            at = np.flatnonzero(ids < movable)             # never an end token, so a token follows
            for keys in (2 * ids[at] * CLASSES + before[at], (2 * ids[at] + 1) * CLASSES + now[at + 1]):
                often = keys < len(dense)
                dense += np.bincount(keys[often], minlength=len(dense))
                held.append(keys[~often])
                size += len(held[-1])
            if size > 1 << 21:
                yield out(held)
                held, size = [], 0
        if size:
            yield out(held)
        for sign, counts in ((0, dense), (-1, table)):
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(seen if sign == 0 else -1 - seen), pa.array(counts[seen])], ["key", "n"])

    return write_table(ranks.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "contexts")


def bigrams_of(contexts: DataFrame) -> np.ndarray:
    got = contexts.filter("key < 0").toArrow()             # at most CLASSES ** 2 rows
    table = np.zeros(CLASSES ** 2)
    table[-1 - got.column("key").to_numpy()] = got.column("n").to_numpy()
    return table.reshape(CLASSES, CLASSES)


def likely(table: np.ndarray, classes: int) -> np.ndarray:
    """[side * CLASSES + class of the neighbour, class]: log likelihood of a neighbour for a word of a class.

    The last class is the end token's own.
    """
    t = table + 0.5
    after = np.log(t) - np.log(t.sum(axis=1, keepdims=True))
    before = np.log(t) - np.log(t.sum(axis=0, keepdims=True))
    terms = np.concatenate((before, after.T))
    terms[:, classes - 1:] = -1e9
    return terms


def best_classes(codes: np.ndarray, n: np.ndarray, lengths: np.ndarray, now: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """The best class of each word; its contexts (codes with counts) are runs of ``lengths``."""
    gains = np.add.reduceat(n[:, None] * terms[codes], np.concatenate(([0], np.cumsum(lengths)[:-1])))
    best = gains.argmax(axis=1)
    rows = np.arange(len(now))
    return np.where(gains[rows, now] >= gains[rows, best] - 1e-9, now, best)


def moved(contexts: DataFrame, classes: Classes) -> Classes:
    """Every word with contexts in the class in which its neighbours are most likely."""
    terms, of_rank = likely(bigrams_of(contexts), classes.count), classes.of_rank

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                ranks, pairs = batch.column(0).to_numpy(), batch.column(1)
                inner = pairs.flatten()
                new = best_classes(inner.field(0).to_numpy(), inner.field(1).to_numpy(), pairs.value_lengths().to_numpy(), of_rank[ranks], terms)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new.astype(np.int32))], ["rank", "class"])

    width = 2 * CLASSES                                    # a word has at most so many contexts
    words = (contexts.filter("key >= 0").groupBy(F.floor(F.col("key") / width).alias("rank"))
             .agg(F.collect_list(F.struct(F.pmod("key", F.lit(width)).alias("code"), "n")).alias("pairs")))
    got = words.mapInArrow(run, "rank long, class int").toArrow()       # one row per frequent word at most
    new = of_rank.copy()
    new[got.column("rank").to_numpy()] = got.column("class").to_numpy()
    return Classes(new, classes.of_tail, classes.count)


@dataclass
class Classes:
    """Class of each frequent word, by rank, and of each tail group; the last class is the end token's."""

    of_rank: np.ndarray
    of_tail: np.ndarray
    count: int

    @property
    def end(self) -> int:
        return self.count - 1

    @property
    def numbers(self) -> np.ndarray:
        return numbers_of(self.of_rank, self.of_tail)


@dataclass
class Model:
    words: list[bytes]         # frequent words, most frequent first
    counts: np.ndarray         # of the frequent words, then of the end token
    total: int                 # training tokens
    distinct: int
    classes: Classes
    step: np.ndarray           # log10 P(class | class before) - log10 mass(class)

    @property
    def base_mass(self) -> float:
        return float(np.log10(self.total + SMOOTH * (self.distinct + 1)))


def learn(training: DataFrame, frequent: int = FREQUENT, first: int = FIRST, classes: int = CLASSES,
          sweeps: int = SWEEPS, evidence: int = EVIDENCE) -> tuple[Model, DataFrame]:
    """(model, table of all counts) of the rows of ``training``, column ``text``; ``classes`` is at most ``CLASSES``."""
    vocabulary = write_table(count_tokens(training), "vocabulary")
    is_tail = F.col("word") != F.lit(END)
    size = vocabulary.agg(F.sum("n"), F.count(F.lit(1)), F.sum(F.when(~is_tail, F.col("n")))).first()
    total, distinct, ends = (int(x or 0) for x in size)
    top = most_frequent(vocabulary.filter(is_tail & (F.length("word") <= WORD_BYTES)), frequent)
    words = top.column("word").to_pylist()
    counts = np.append(top.column("n").to_numpy().astype(float), float(ends))
    ranks = write_ranks(training, words)

    # symbols: the first words, the end token, the tail groups (with all other frequent words)
    first = min(first, len(words))
    tails = np.array([tail_group(w) for w in words], np.int64)
    symbols = numbers_of(np.append(np.arange(first), first + 1 + tails[first:]), first + 1 + np.arange(TAIL_GROUPS))
    of_symbol = exchange(count_pairs(ranks, symbols, first, first + 1 + TAIL_GROUPS), first, classes)
    of_tail = of_symbol[first + 1:]
    own = Classes(np.append(of_symbol[:first], of_tail[tails[first:]]), of_tail, int(of_symbol.max()) + 1)
    movable = int((counts[:-1] >= evidence).sum())         # ranks are in the order of counts
    for _ in range(sweeps if movable else 0):
        own = moved(count_contexts(ranks, own, movable), own)

    # mass: frequent words where they are, the end token, and what is left of each tail group
    k = own.count
    groups = vocabulary.filter(is_tail).groupBy(tail_group_column(F.col("word")).alias("g")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    rest = np.zeros(TAIL_GROUPS)
    for r in groups:
        rest[r.g] = r.n + SMOOTH * r.v
    rest -= np.bincount(tails, counts[:-1] + SMOOTH, TAIL_GROUPS)
    class_mass = (np.bincount(own.of_rank, counts[:-1] + SMOOTH, k) + np.bincount(of_tail, np.maximum(rest, 0), k))
    class_mass[np.unique(of_tail)] += SMOOTH               # one word not seen in each class with tail groups
    class_mass[own.end] += ends + SMOOTH
    live = np.isin(np.arange(k), np.concatenate((own.of_rank, of_tail, [own.end])))       # exchange may empty a class
    class_mass = np.where(live, class_mass, 0.0)
    table = count_pairs(ranks, own.numbers, own.end, k)
    kinds = np.maximum((table > 0).sum(axis=1), 1)[:, None]
    p = (table + kinds * (class_mass / class_mass.sum())) / (table.sum(axis=1)[:, None] + kinds)
    step = (np.log10(np.maximum(p, 1e-300)) - np.log10(np.where(live, class_mass, 1.0)) if total
            else np.full((k, k), -np.log10(SMOOTH)))
    return Model(words, counts, total, distinct, own, step), vocabulary


READ = ("row long, doc_id long, {}n_tokens long, known long, logs double, steps double, "
        "rare array<struct<word: binary, n: int>>")


def score(texts: DataFrame, model: Model, vocabulary: DataFrame, keep: str) -> DataFrame:
    """doc_id, ``keep``, n_tokens, n_known, train_tokens, base_score, score for every whole text."""
    rows = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(keep), F.col("text").cast("string").cast("binary").alias("text"))
    kind = rows.schema[keep].dataType

    def run(batches):
        rank, logs, end = {w: i for i, w in enumerate(model.words)}, np.log10(model.counts + SMOOTH), len(model.words)
        of_rank, of_tail = np.append(model.classes.of_rank, model.classes.end), model.classes.of_tail
        get, number = rank.get, TaskContext.get().partitionId() << 33
        for batch in batches:
            out = []
            for text in batch.column(2):
                words = words_of(text.as_py())
                ranks = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
                ranks = np.append(ranks, np.int32(end))
                known = ranks >= 0
                at = np.flatnonzero(~known)
                rare = [words[i] for i in at]
                classes = of_rank[ranks]
                classes[at] = of_tail[[tail_group(w) for w in rare]] if rare else 0
                steps = model.step[np.append(model.classes.end, classes[:-1]), classes].sum()
                out.append((number, len(ranks), int(known.sum()) if model.total else 0,
                            float(logs[ranks[known]].sum()), float(steps),
                            [{"word": w, "n": n} for w, n in Counter(rare).items()]))
                number += 1
            cols = list(zip(*out)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
                     pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())])))
            new = [pa.array(c, t) for c, t in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays([new[0], batch.column(0), batch.column(1), *new[1:]],
                                             ["row", "doc_id", keep, "n_tokens", "known", "logs", "steps", "rare"])

    read = write_table(rows.mapInArrow(run, READ.format(f"{keep} {kind.simpleString()}, ")), "scores")
    rare = read.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    found = (rare.join(vocabulary, "word", "left").groupBy("row")
             .agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTH))).alias("rare_logs"),
                  F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known")))
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    return (read.drop("rare").join(found, "row", "left")
            .select("doc_id", keep, "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
                    F.lit(model.total).cast("long").alias("train_tokens"),
                    (logs - F.col("n_tokens") * F.lit(model.base_mass)).alias("base_score"),
                    (logs + F.col("steps")).alias("score")))


ship(__name__)
