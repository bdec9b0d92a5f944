"""Quality classifier by co-training a text view and a metadata view.

Two logistic classifiers tell clean documents from those to reject (low quality or toxic). The
text view sees what the text is made of: words, word beginnings, endings that are no letters,
and ratios of the whole text. The metadata view sees source, language, their pair, and sizes; it
never sees words. Both start from labelled documents. In each round every view scores *all* documents that are not
among the labelled rows, and those of which it is certain are, with its verdict, evidence for the *other*
view: over the whole table the other view's features are counted by verdict, and a feature that too few
labelled rows hold to settle gets its log odds from these counts as weight. A view is calibrated on labelled rows
kept back from training, and is only as certain as it was right there, so a weak view exchanges
little or nothing. At the end a logistic combination of both calibrated views, fitted on the rows kept back,
scores every whole text.

Bounds: ``LABELLED_ROWS`` labelled documents, drawn by the hash of their ids, are read on the driver as hashed
features for fitting (their ids are joined as a broadcast of that size). Unlabelled documents are not drawn at all:
their features are written once, each round reads them and sends two counts per feature, at most ``FEATURES`` numbers a
view and verdict, as a model has.

Defined results: a null or empty text has no words and is scored by its ratios and metadata; a text of any length
counts whole; null source or language is a value of its own; a label row is "reject" if quality is 0 or
toxic is 1, "clean" if quality is 1, else it is no label; if an id has several, one "reject" decides (of
rows that share an id the least text is read for fitting); of equally drawn labels the lower id comes first; without
labels of both kinds every document scores 1 and is kept; an empty table gives no rows; repeated rows get the same
score; other columns pass through.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import ship, write_table

LABELLED_ROWS = 8000
ROUNDS = 3
CERTAIN = 0.98             # calibrated probability from which a pseudo-label is exchanged
STRONG = 1.0               # log odds from which pseudo-labels count as evidence for a feature
MOST = 4.0                 # and at most this much
FEATURES = 1 << 18
KEEP_FROM = 0.4            # score from which a document is kept
MIN_ROWS = 4               # training documents a feature must be in
SETTLED = 30               # labelled documents from which pseudo-labels add nothing to a feature
MIN_Z = 3.0                # standard deviations its share must differ by
RIDGE = 0.05

_UPPER = bytes(range(65, 91))
_PLAIN = bytes([*range(48, 58), *range(65, 91), *range(97, 123), 32, 10, *range(128, 256)])
_MARKS = b".,;:!?()[]{}\"'|*%$&#<>/\\-_=+~^`"


def _level(value: float, steps: tuple[float, ...]) -> int:
    return sum(value >= s for s in steps)


def text_features(text: str | None) -> np.ndarray:
    """Sorted hashed features of the whole text."""
    data = (text or "").encode()
    words = data.split()
    n, size = max(1, len(words)), max(1, len(data))
    own = set(words)
    bare = {w.lower().strip(_MARKS) for w in own}
    names = [b"w " + w for w in bare]
    names += {b"b " + w[:5] for w in bare if len(w) > 5}
    names += {b"e " + w[-2:] for w in own if w[-1:] in _MARKS}
    ratios = (("upper", (size - len(data.translate(None, _UPPER))) / size, (.01, .03, .08, .2, .4)),
              ("marks", len(data.translate(None, _PLAIN)) / size, (.005, .02, .04, .08, .15)),
              ("again", sum(map(eq, words, words[1:])) / n, (.01, .05, .2, .5)),
              ("unique", len(own) / n, (.05, .2, .4, .6, .8)),
              ("length", len(data) / n, (3, 4, 5, 6, 7, 9, 12)))
    names += [f"r {name} {_level(v, steps)}".encode() for name, v, steps in ratios]
    names += [f"p {a} {_level(v, s)} {b} {_level(u, t)}".encode()
              for (a, v, s), (b, u, t) in zip(ratios, ratios[1:])]
    return np.unique(np.array([zlib.crc32(x) % FEATURES for x in names], np.int32))


def metadata_features(source, lang, n_chars) -> np.ndarray:
    size = -1 if n_chars is None else int(n_chars).bit_length()
    names = [f"s {source}", f"l {lang}", f"sl {source} {lang}", f"n {size}", f"ln {lang} {size}"]
    return np.unique(np.array([zlib.crc32(x.encode()) % FEATURES for x in names], np.int32))


@dataclass
class View:
    """Sparse logistic classifier and its calibration."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES, np.float32))
    bias: float = 0.0
    slope: float = 1.0
    offset: float = 0.0

    def raw(self, features: np.ndarray) -> float:
        return float(self.weights[features].sum()) + self.bias

    def logit(self, features: np.ndarray) -> float:
        return self.slope * self.raw(features) + self.offset


@dataclass
class Model:
    text: View
    metadata: View
    mix: np.ndarray            # of the text logit, the metadata logit, and 1

    def score(self, text: np.ndarray, metadata: np.ndarray) -> tuple[float, float, float]:
        """(probability of clean, by the text alone, by the metadata alone)"""
        a, b = self.text.logit(text), self.metadata.logit(metadata)
        return tuple(float(1 / (1 + np.exp(-np.clip(x, -50, 50)))) for x in (self.mix @ (a, b, 1.0), a, b))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Newton's method for a few dense columns."""
    theta = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (p - y) + ridge * theta
        theta -= np.linalg.solve((x.T * (p * (1 - p) + 1e-6)) @ x + ridge * np.eye(len(theta)), grad)
    return theta


def significant(c1: np.ndarray, c0: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Features in enough rows whose share differs between both kinds."""
    share = (c1 + c0) / (n1 + n0)
    deviation = np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / n1 + 1 / n0))
    return (c1 + c0 >= MIN_ROWS) & (np.abs(c1 / n1 - c0 / n0) >= MIN_Z * deviation)


def evidence(counts: np.ndarray | None) -> np.ndarray:
    """Log odds of the features by pseudo-labels; 0 where they say little."""
    if counts is None or not counts[:, FEATURES].all():
        return np.zeros(FEATURES)
    (c0, c1), (n0, n1) = counts[:, :FEATURES], counts[:, FEATURES]
    odds = np.log((c1 + 0.5) / (n1 + 1)) - np.log((c0 + 0.5) / (n0 + 1))
    return np.where(significant(c1, c0, n1, n0) & (np.abs(odds) >= STRONG), np.clip(odds, -MOST, MOST), 0.0)


def fit(rows: list[np.ndarray], clean: np.ndarray, counts: np.ndarray | None = None) -> View:
    """Logistic regression over the features that differ significantly between both kinds of labelled rows.

    Features that too few labelled rows hold to settle have the weights that the pseudo-labels give them (``counts``).
    """
    n1, n0 = clean.sum(), (~clean).sum()
    c1, c0 = np.zeros(FEATURES, np.int32), np.zeros(FEATURES, np.int32)
    for row, kind in zip(rows, clean):                     # features of a row are distinct
        (c1 if kind else c0)[row] += 1
    use = significant(c1, c0, n1, n0)
    view, y = View(), clean.astype(float)
    given = evidence(counts) * (~use & (c1 + c0 < SETTLED))
    told = np.array([given[r].sum() for r in rows])
    rows = [r[use[r]] for r in rows]
    flat, of = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, square, bias, bias_square = np.zeros(FEATURES), np.full(FEATURES, 1e-8), 0.0, 1e-8
    for _ in range(300):                                   # Adagrad on the whole set
        z = np.bincount(of, w[flat], len(rows)) + told + bias
        err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grad = np.bincount(flat, err[of], FEATURES) + RIDGE * w
        square += grad ** 2
        bias_square += err.sum() ** 2
        w -= 0.3 * grad / np.sqrt(square)
        bias -= 0.3 * err.sum() / np.sqrt(bias_square)
    view.weights, view.bias = (w + given).astype(np.float32), float(bias)
    return view


def calibrate(view: View, rows: list[np.ndarray], clean: np.ndarray) -> None:
    raw = np.array([view.raw(r) for r in rows])
    scale = np.abs(raw).mean() or 1.0
    slope, view.offset = logistic(np.stack([raw / scale, np.ones(len(raw))], 1), clean.astype(float))
    view.slope = max(0.0, slope) / scale


def certain(view: View, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """1 for rows that the view is certain are clean, 0 for those to reject, -1 for the others; rows are runs of ``flat``."""
    of = np.repeat(np.arange(len(lengths)), lengths)
    raw = np.bincount(of, view.weights[flat], len(lengths)) + view.bias
    limit = np.log(CERTAIN / (1 - CERTAIN))
    logit = view.slope * raw + view.offset
    return np.where(logit >= limit, 1, np.where(logit <= -limit, 0, -1))


def tally(views: list[View], rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """[view, kind, feature]: rows that hold a view's feature, by the certain verdict of the other view; at ``FEATURES`` all rows."""
    counts = np.zeros((2, 2, FEATURES + 1), np.int64)
    verdicts = [certain(v, *r) for v, r in zip(views, rows)]
    for k, (flat, lengths) in enumerate(rows):
        told = verdicts[1 - k]
        of_feature = np.repeat(told, lengths)
        for kind in (0, 1):
            counts[k, kind, :FEATURES] += np.bincount(flat[of_feature == kind], minlength=FEATURES)
            counts[k, kind, FEATURES] += int((told == kind).sum())
    return counts


def co_train(text: list[np.ndarray], metadata: list[np.ndarray], clean: np.ndarray, exchange, rounds: int = ROUNDS) -> Model | None:
    """Model from labelled rows (a fourth of them kept back) and the pseudo-labels of all others.

    ``exchange(views)`` gives the ``tally`` of the unlabelled rows.
    """
    back = np.arange(len(clean)) % 4 == 3
    learn = ~back
    if not (clean[learn].any() and (~clean[learn]).any() and clean[back].any() and (~clean[back]).any()):
        return None
    pick = lambda rows, mask: [r for r, m in zip(rows, mask) if m]
    counts: list[np.ndarray | None] = [None, None]
    for r in range(rounds + 1):
        fitted = []
        for rows, more in zip((text, metadata), counts):
            view = fit(pick(rows, learn), clean[learn], more)
            calibrate(view, pick(rows, back), clean[back])
            fitted.append(view)
        if r == rounds:
            break
        before, counts = counts, list(exchange(fitted))
        if all(a is not None and np.array_equal(a, b) for a, b in zip(before, counts)):
            break
    logits = np.array([[v.logit(r) for v, r in zip(fitted, pair)] + [1.0]
                       for pair in zip(pick(text, back), pick(metadata, back))])
    return Model(*fitted, logistic(logits, clean[back].astype(float), ridge=0.1))


def lists_of(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column as views of its values."""
    return [v for chunk in column.chunks
            for v in np.split(chunk.flatten().to_numpy(), np.cumsum(chunk.value_lengths().to_numpy())[:-1])]


def labels_of(labels: DataFrame) -> DataFrame:
    """(doc_id, clean) with one row per labelled id."""
    reject = (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False)))
    known = labels.withColumn("clean", F.when(reject, 0).when(F.col("quality") == 1, 1))
    return known.filter("doc_id is not null and clean is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("clean").alias("clean"))


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.col(source_col).cast("string").alias("source"),
                       F.col(lang_col).cast("string").alias("lang"), F.length(text).cast("long").alias("size"))


def _features(batch: pa.RecordBatch) -> list[pa.Array]:
    """Hashed features of rows with text, source, lang and size."""
    rows = batch.to_pylist()
    return [pa.array([text_features(r["text"]) for r in rows], pa.list_(pa.int32())),
            pa.array([metadata_features(r["source"], r["lang"], r["size"]) for r in rows], pa.list_(pa.int32()))]


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(), column.value_lengths().to_numpy()


def exchange_over(features: DataFrame):
    """``exchange`` of ``co_train`` over a table of features: counted in tasks, added up in Spark."""
    slots = 2 * 2 * (FEATURES + 1)

    def run(views: list[View]) -> np.ndarray:
        def count(batches):
            counts = np.zeros((2, 2, FEATURES + 1), np.int64)
            for batch in batches:
                if batch.num_rows:
                    counts += tally(views, [_flat(batch.column(0)), _flat(batch.column(1))])
            seen = np.flatnonzero(counts.reshape(-1))
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts.reshape(-1)[seen], pa.int64())], ["slot", "n"])

        got = features.mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()   # at most ``slots`` rows
        counts = np.zeros(slots, np.int64)
        counts[got.column("slot").to_numpy()] = got.column("n").to_numpy()
        return counts.reshape(2, 2, FEATURES + 1)
    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          lang_col: str = "lang", labelled_rows: int = LABELLED_ROWS, rounds: int = ROUNDS) -> Model | None:
    """Co-trained model, or None if there are not both kinds of labels."""
    known = labels_of(labels)
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id")).filter("doc_id is not null")
    drawn = known.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows)

    def read(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *_features(batch)], ["doc_id", "clean", "text", "metadata"])

    rows = _rows(docs, id_col, text_col, source_col, lang_col)
    got = (rows.join(F.broadcast(drawn), "doc_id")          # at most labelled_rows rows of two numbers
           .groupBy("doc_id", "clean").agg(F.min(F.struct("text", "source", "lang", "size")).alias("r"))   # ids may repeat
           .select("doc_id", "clean", "r.*")
           .mapInArrow(read, "doc_id long, clean int, text array<int>, metadata array<int>").toArrow())
    text, metadata = (lists_of(got.column(c)) for c in ("text", "metadata"))
    own = [k for *_, k in sorted((zlib.crc32(str(i).encode()), i, k) for k, i in enumerate(got.column("doc_id").to_pylist()))]
    clean = got.column("clean").to_numpy()[own] == 1
    if clean.all() or not clean.any():
        return None
    labelled = pa.array(sorted(got.column("doc_id").to_pylist()), pa.int64())

    def others(batches):
        for batch in batches:
            left = batch.filter(pc.invert(pc.fill_null(pc.is_in(batch.column(0), value_set=labelled), False)))
            yield pa.RecordBatch.from_arrays(_features(left), ["text", "metadata"])

    features = write_table(rows.mapInArrow(others, "text array<int>, metadata array<int>"), "quality-features")
    return co_train([text[k] for k in own], [metadata[k] for k in own], clean, exchange_over(features), rounds)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """(doc_id, score, by_text, by_metadata, kept) for every whole text."""
    def run(batches):
        for batch in batches:
            got = [(1.0, 1.0, 1.0) if model is None else
                   model.score(text_features(r["text"]), metadata_features(r["source"], r["lang"], r["size"]))
                   for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([g[k] for g in got], pa.float64()) for k in range(3)],
                 pa.array([g[0] >= KEEP_FROM for g in got], pa.bool_())],
                ["doc_id", "score", "by_text", "by_metadata", "kept"])

    rows = _rows(docs, id_col, text_col, source_col, lang_col)
    return rows.mapInArrow(run, "doc_id long, score double, by_text double, by_metadata double, kept boolean")


def keep_clean(docs: DataFrame, model: Model | None, text_col: str = "text", source_col: str = "source",
               lang_col: str = "lang") -> DataFrame:
    """The documents that the model keeps, as they came; without a shuffle."""
    if model is None:
        return docs
    names = [c.lower() for c in docs.columns]
    text_at, source_at, lang_at = (names.index(c.lower()) for c in (text_col, source_col, lang_col))

    def run(batches):
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            sources, langs = batch.column(source_at).to_pylist(), batch.column(lang_at).to_pylist()
            kept = [model.score(text_features(t), metadata_features(s, lang, None if t is None else len(t)))[0] >= KEEP_FROM
                    for t, s, lang in zip(texts, sources, langs)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


ship(__name__)
