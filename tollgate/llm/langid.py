"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1; a binary n-gram classifier per bit tells the
languages with +1 from those with -1. A classifier is a vector of log odds over hashed byte
trigrams of the lower-cased text (digits and ASCII punctuation count as spaces), so all of them come from one table of trigram
counts per language, which Spark counts over all training texts. The mean log odds of a text
are calibrated per bit on a bounded sample of training documents (``SAMPLE_ROWS``), which also
gives the weight of each bit's loss: bits that are often wrong count less. The language whose
codeword has the least weighted logistic loss is predicted; ``ambiguous`` says that the score of
the best is below ``SURE``.

Sizes: one row of ``BUCKETS`` counts per language comes to the driver and ``bits * BUCKETS`` floats go
to each task, whatever the input.

Defined results: ``und`` with score 0 and ambiguous for a null text, one without letters, or if
no language could be learned; with one language learned it is predicted with score 1; rows
with a null language are not learned from; ties go to the first language in order; repeated
rows count as often as they come; other columns are ignored or pass through.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import ship

BUCKETS = 1 << 15
SAMPLE_ROWS = 4000
SURE = 0.75
UNKNOWN = "und"
EXHAUSTIVE = 6             # languages up to which every partition into two is a bit
CHUNK = 1 << 16

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32


def trigrams(text: str) -> np.ndarray:
    """Bucket of each byte trigram of the whole text, in order; it is framed by spaces."""
    raw = _FOLD[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    code = raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:]
    code = code[code != 0x202020]
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15)


def codewords(n: int, seed: int = 42) -> np.ndarray:
    """n codewords as rows of +1 and -1; no column is constant, no two are equal or opposite."""
    if n <= EXHAUSTIVE:
        columns = [c for c in product((1, -1), repeat=n) if c[0] == 1 and -1 in c]
    else:
        rng, columns = np.random.Generator(np.random.PCG64(seed)), []
        seen: set[tuple] = set()
        while len(columns) < 10 * int(np.ceil(np.log2(n))):
            c = tuple(int(x) for x in rng.choice((1, -1), n))
            c = c if c[0] == 1 else tuple(-x for x in c)
            if -1 in c and c not in seen:
                seen.add(c)
                columns.append(c)
    return np.array(columns, np.int8).reshape(-1, n).T


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray          # languages x bits
    odds: np.ndarray          # buckets x bits, log odds
    slope: np.ndarray         # calibration of each bit
    offset: np.ndarray
    weight: np.ndarray        # of each bit's loss


def margins(odds: np.ndarray, text: str) -> np.ndarray:
    """Mean log odds per bit over all trigrams of the text."""
    grams, total = trigrams(text), np.zeros(odds.shape[1])
    for at in range(0, len(grams), CHUNK):
        total += odds[grams[at:at + CHUNK]].sum(axis=0, dtype=np.float64)
    return total / max(1, len(grams))


def losses(model: Model, text: str) -> np.ndarray:
    """Weighted logistic loss per language."""
    value = model.slope * margins(model.odds, text) + model.offset
    return np.logaddexp(0, -model.code * value) @ model.weight


def decide(model: Model, text: str | None) -> tuple[str, float, bool]:
    """(language, score, ambiguous) of one text."""
    if not model.languages or text is None or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, True
    loss = losses(model, text)
    share = np.exp(loss.min() - loss)
    score = float(1 / share.sum())
    return model.languages[int(loss.argmin())], score, score < SURE


def count_trigrams(rows: DataFrame) -> DataFrame:
    """(lang, bucket, n) over the rows' (lang, text); bucket -1 counts documents."""
    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                count = sums.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                count[-1] += 1
                grams = trigrams(text.as_py())
                if len(grams) < BUCKETS:
                    np.add.at(count, grams, 1)
                else:
                    count[:-1] += np.bincount(grams, minlength=BUCKETS)
        for lang, count in sums.items():
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(np.where(at == BUCKETS, -1, at).astype(np.int32)), pa.array(count[at])],
                ["lang", "bucket", "n"])

    return rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def calibrate(value: np.ndarray, sign: np.ndarray) -> tuple[float, float, float]:
    """(slope, offset, loss weight) of a logistic curve through one bit's margins."""
    if not len(value) or (sign == sign[0]).all():
        return 1.0, 0.0, 1.0
    scale = np.abs(value).mean() or 1.0
    x = np.stack([value / scale, np.ones(len(value))])
    theta, want = np.array([1.0, 0.0]), (sign > 0).astype(float)
    for _ in range(30):                                    # Newton steps, with a prior that keeps them finite
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -30, 30)))
        grad = x @ (p - want) + 0.05 * theta
        theta = theta - np.linalg.solve((x * (p * (1 - p) + 1e-6)) @ x.T + 0.05 * np.eye(2), grad)
    wrong = np.mean((theta @ x > 0) != (sign > 0))
    return float(theta[0] / scale), float(theta[1]), float(max(0.05, 1 - 2 * wrong))


def learn(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model of the languages of the rows where ``training`` holds."""
    rows = docs.filter(training & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)).alias("draw"))
    table = count_trigrams(rows.select("lang", "text")).toArrow().to_pandas()
    languages = sorted(table["lang"].unique())
    counts = np.zeros((len(languages), BUCKETS + 1))
    counts[[languages.index(x) for x in table["lang"]], table["bucket"]] = table["n"]
    n_docs, counts = counts[:, -1].sum(), counts[:, :-1]
    code = codewords(len(languages)) if len(languages) > 1 else np.ones((len(languages), 0), np.int8)

    smooth = counts + 0.5
    plus, minus = (code == 1).T @ smooth, (code == -1).T @ smooth
    odds = (np.log(plus / plus.sum(axis=1, keepdims=True))
            - np.log(minus / minus.sum(axis=1, keepdims=True))).T.astype(np.float32) if len(languages) > 1 else np.zeros((BUCKETS, 0), np.float32)

    def measured(batches):
        for batch in batches:
            value = [margins(odds, t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value, pa.list_(pa.float64()))], ["lang", "value"])

    drawn = rows.filter(F.col("draw") < int((1 << 20) * min(1.0, sample_rows / max(1, n_docs)))).select("lang", "text")
    sample = drawn.mapInArrow(measured, "lang string, value array<double>").limit(2 * sample_rows).toArrow().to_pandas()
    signs = code[[languages.index(x) for x in sample["lang"]]] if len(sample) else np.zeros((0, code.shape[1]))
    values = np.stack(sample["value"]) if len(sample) and code.shape[1] else np.zeros((0, code.shape[1]))
    fits = np.array([calibrate(values[:, b], signs[:, b]) for b in range(code.shape[1])]).reshape(-1, 3)
    return Model(languages, code, odds, *fits.T)


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with lang_pred, score, ambiguous for every whole text."""
    rows = docs.select(*keep, F.col(text_col).cast("string").alias("text_to_read"))
    schema = rows.drop("text_to_read").schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")

    def run(batches):
        for batch in batches:
            got = [decide(model, t.as_py()) for t in batch.column(batch.num_columns - 1)]
            new = [pa.array([g[k] for g in got], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], schema.names)

    return rows.mapInArrow(run, schema)


ship(__name__)
