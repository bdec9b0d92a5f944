"""Line deduplication by a suffix array over line ids, with DataFrame functions only.

Of all copies of a stretch of lines with at least ``MIN_CHARS`` characters (line ends included)
the first (smallest id, then place) stays; the lines of later copies go. Every such stretch is a
union of *runs*, the shortest stretches of that size that begin or end at some line, so only
runs are compared, and the unions of deleted runs are the maximal repeated stretches.

Equal runs lie next to each other in the suffix array of the line sequences, as an interval
whose longest common prefix is at least the run's length. Suffixes are ranked by prefix
doubling: a line's rank is its place among all repeated lines, and the rank over 2h lines that of the
pair (rank over h lines here, rank over h lines h places further), in the order of a
distributed sort. A suffix whose prefix is unique drops out, and doubling ends when no run is
as long as the next prefix, so ranks cost what repeats, not what the corpus holds. A run of q
lines with h <= q < 2h is named by two overlapping ranks.

Defined results: a null text has no lines and stays null; an empty text is one empty line;
lines are cut at line feeds, and texts and lines of any length count whole; a null id is the smallest; rows equal in id and text are the same
document and keep the same lines; a text all of whose lines went is empty; an empty table
stays empty; other columns pass through, ``n_chars`` (if there) is brought up to date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import dealt_anew, doc_key, write_table

MIN_CHARS = 60
KEY = ["key_id", "key_text"]


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, pos, a, b, chars) per line: a and b are independent 64-bit hashes of the line."""
    lines = F.transform(F.split(F.col(text_col).cast("string"), "\n", -1),
                        lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"),
                                           (F.length(x) + 1).alias("chars")))
    return (docs.filter(F.col(text_col).isNotNull()).select(*doc_key(id_col, text_col), F.posexplode(lines))
            .select(*KEY, "pos", "col.a", "col.b", "col.chars"))


def _ranked(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """(by, rank) of the values of ``by`` at more than one place; ranks ascend in their order.

    The least and greatest place differ unless a value occurs once: a map-side aggregate.
    """
    here = F.struct(*KEY, "pos")
    classes = rows.groupBy(*by).agg(F.min(here).alias("first"), F.max(here).alias("last")).filter("first < last").select(*by)
    return write_table(classes, name).orderBy(*by).withColumn("rank", F.monotonically_increasing_id())


def _by_document(suffixes: DataFrame) -> DataFrame:
    """One row per document with its suffixes in order: array ``s`` of (pos, rank, chars, qs)."""
    return suffixes.groupBy(*KEY).agg(F.sort_array(F.collect_set(F.struct("pos", "rank", "chars", "qs"))).alias("s"))


def _run_lengths(documents: DataFrame, min_chars: int) -> DataFrame:
    """Fills ``qs``: lengths of the runs that begin at each line, as far as neighbouring lines
    are repeated. A line has at least one character, so a run has at most ``min_chars`` lines."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("chars"))

    def needed(x, lines, step):
        some = F.aggregate(lines, zero, lambda acc, y: F.when(
            (acc["chars"] < min_chars) & (y["pos"] == x["pos"] + acc["n"] * step),
            F.struct((acc["n"] + 1).alias("n"), (acc["chars"] + y["chars"]).alias("chars"))).otherwise(acc))
        return F.when(some["chars"] >= min_chars, some["n"])

    def both(x, i):
        back = F.greatest(i + 2 - min_chars, F.lit(1))
        return F.struct(x["pos"].alias("pos"), x["rank"].alias("rank"), x["chars"].alias("chars"),
                        needed(x, F.slice("s", i + 1, min_chars), 1).alias("ahead"),
                        needed(x, F.reverse(F.slice("s", back, i + 2 - back)), -1).alias("back"))

    def begin_here(x, i):
        ends = F.transform(F.slice("s", i + 1, min_chars), lambda y, k: F.when(
            (y["back"] == k + 1) & (y["pos"] == x["pos"] + k), k + 1))
        return F.struct(x["pos"].alias("pos"), x["rank"].alias("rank"), x["chars"].alias("chars"),
                        F.array_distinct(F.array_compact(F.concat(F.array(x["ahead"]), ends))).alias("qs"))

    return documents.withColumn("s", F.transform("s", both)).withColumn("s", F.transform("s", begin_here))


def _rank_ahead(x, i, steps):
    """Rank of the suffix ``steps`` lines further, null if that one is not repeated."""
    there = F.get(F.col("s"), i + steps)
    return F.when(there["pos"] == x["pos"] + steps, there["rank"])


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, pos, q): later copies of runs, as first line and number of lines."""
    lines = write_table(line_table(docs, id_col, text_col), "lines")
    suffixes = lines.join(_ranked(lines, ["a", "b"], "line-ranks"), ["a", "b"]).select(
        *KEY, "pos", "rank", "chars", F.array().cast("array<int>").alias("qs"))

    documents = write_table(_run_lengths(_by_document(suffixes), min_chars), "suffixes")
    longest = documents.agg(F.max(F.array_max(F.flatten(F.transform("s", lambda x: x["qs"]))))).first()[0] or 0

    found, h = None, 1
    while h <= longest:
        runs = F.flatten(F.transform("s", lambda x, i: F.transform(
            F.filter(x["qs"], lambda q: (q >= h) & (q < 2 * h)),
            lambda q: F.struct(x["pos"].alias("pos"), q.alias("q"), x["rank"].alias("r1"),
                               _rank_ahead(x, i, q - h).alias("r2")))))
        named = documents.select(*KEY, F.explode(runs).alias("r")).select(*KEY, "r.*").filter("r2 is not null")
        here = F.struct(*KEY, "pos")
        firsts = named.groupBy("q", "r1", "r2").agg(F.min(here).alias("first"), F.max(here).alias("last")) \
            .filter("first < last").select("q", "r1", "r2", "first")
        later = named.join(dealt_anew(firsts), ["q", "r1", "r2"]).filter(F.col("first") < here).select(*KEY, "pos", "q")
        found = later if found is None else found.union(later)
        if 2 * h <= longest:
            pairs = F.transform("s", lambda x, i: F.struct(
                x["pos"].alias("pos"), x["rank"].alias("r1"), _rank_ahead(x, i, F.lit(h)).alias("r2"),
                x["chars"].alias("chars"), x["qs"].alias("qs")))
            longer = write_table(documents.select(*KEY, F.explode(F.filter(pairs, lambda p: p["r2"].isNotNull())).alias("p"))
                                 .select(*KEY, "p.*"), "pairs")
            ranked = longer.join(_ranked(longer, ["r1", "r2"], "pair-ranks"), ["r1", "r2"])
            documents = write_table(_by_document(ranked.select(*KEY, "pos", "rank", "chars", "qs")), "suffixes")
        h *= 2
    if found is None:
        return lines.select(*KEY, "pos", F.lit(1).alias("q")).limit(0)
    return write_table(found, "runs")


def deleted_stretches(runs: DataFrame) -> DataFrame:
    """(key, cuts): per document the maximal stretches of deleted lines, as (start, end) in order."""
    before = Window.partitionBy(*KEY).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*KEY).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    spans = (runs.withColumn("end", F.col("pos") + F.col("q"))
             .withColumn("new", (F.col("pos") > F.coalesce(F.max("end").over(before), F.lit(-1))).cast("int"))
             .withColumn("stretch", F.sum("new").over(upto)))
    return (spans.groupBy(*KEY, "stretch").agg(F.min("pos").alias("start"), F.max("end").alias("end"))
            .groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """row (the input's columns), text (what stays), n_lines, n_removed, longest (deleted stretch)."""
    cuts = deleted_stretches(repeated_runs(docs, id_col, text_col, min_chars))
    rows = docs.select(F.struct("*").alias("row"), *doc_key(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    lines = F.split("text", "\n", -1)
    n = F.coalesce(F.size(F.when(F.col("text").isNotNull(), lines)), F.lit(0))
    gaps = F.transform("cuts", lambda c, i: F.struct(
        F.when(i == 0, 0).otherwise(F.get(F.col("cuts"), i - 1)["end"]).alias("at"), c["start"].alias("to")))
    gaps = F.concat(gaps, F.array(F.struct(F.element_at("cuts", -1)["end"].alias("at"), F.size("lines").alias("to"))))
    kept = F.flatten(F.transform(gaps, lambda g: F.slice(F.col("lines"), g["at"] + 1, g["to"] - g["at"])))
    sizes = F.transform("cuts", lambda c: c["end"] - c["start"])
    return (rows.join(cuts, KEY, "left").withColumn("lines", F.when(F.col("cuts").isNotNull(), lines))
            .select("row", F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
                    n.cast("long").alias("n_lines"),
                    F.coalesce(F.aggregate(sizes, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce(F.array_max(sizes), F.lit(0)).cast("long").alias("longest")))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with the lines that stay, in the columns of the input."""
    done = dedup_lines(docs, id_col, text_col, min_chars)
    columns = []
    for name, kind in docs.dtypes:
        if name.lower() == text_col.lower():
            columns.append(F.col("text").cast(kind).alias(name))
        elif name.lower() == "n_chars":
            changed = F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col(f"row.{name}"))
            columns.append(changed.alias(name))
        else:
            columns.append(F.col("row").getField(name).alias(name))
    return done.select(*columns)
