"""Temperature mixing of sources under a token budget.

The share p of each source in all tokens is raised to an exponent a and normalised again. The
exponent is the largest in [0, 1] whose weights reach the target entropy (a part of the greatest
possible, log of the number of sources), or the least one that keeps the repetition of every
source within its limit, whichever is larger: the limit wins. Both are found by bisection;
the sums of ``LEVELS`` halvings ahead are computed in one aggregate, so nothing per source comes
to the driver.

Weights times budget give each source its tokens: whole passes (epochs) and a rest. In every
epoch a hash of document and epoch permutes a source's documents into numbered blocks of about
``BLOCK_TOKENS`` tokens; the rest takes blocks in order, and of the block in which it ends the
documents in hash order until the rest is used up. Running sums thus go over one row per block,
and over the documents of one block per source, never over a whole source.

Defined results: words as in ``common.WORD``; documents without words (null or empty texts) are
left out; a null source is a source of its own; rows equal in id and text go together; null
ids hash like the text ``null``; an empty table gives an empty mix; other columns pass through,
and columns named like the new ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import WORD, doc_key, write_table

TARGET_ENTROPY = 0.95      # part of the greatest possible entropy
MAX_REPEATS = 4.0          # times a source's tokens may be used
BUDGET = 1.0               # tokens of the mix, in parts of all tokens
BLOCK_TOKENS = 1 << 20
SEED = 42
LEVELS, PASSES = 5, 8      # halvings per aggregate, aggregates: 40 halvings


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Text that tells a null source from all others."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def deal(doc_id: Column, epoch: Column) -> Column:
    """60-bit hash of a document in an epoch."""
    text = F.concat_ws(":", F.lit(str(SEED)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def find_exponent(sources: DataFrame, target_entropy: float, max_repeats: float, budget: float) -> float:
    """The exponent for a table of sources with their token share ``p``."""
    count = sources.count()
    if not count:
        return 1.0
    lo, hi = [0.0, 0.0], [1.0, 1.0]                       # 0: entropy, holds below; 1: repetition, holds above

    def midpoints(a: float, b: float) -> list[float]:
        return [a + (b - a) * k / 2 ** LEVELS for k in range(1, 2 ** LEVELS)]

    def measure(points: list[float]) -> dict[float, tuple[float, float]]:
        """entropy as a part of the greatest, and greatest repetition, by exponent"""
        weights = sources.select("p", F.explode(F.lit(points)).alias("a")).withColumn("w", F.pow("p", F.col("a")))
        rows = weights.groupBy("a").agg(F.sum("w").alias("z"), F.sum(F.col("w") * F.ln("p")).alias("s"),
                                        F.max(F.col("w") / F.col("p")).alias("r"))
        rows = rows.withColumn("h", F.ln("z") - F.col("a") * F.col("s") / F.col("z"))
        return {r.a: (r.h, r.r * budget / r.z) for r in rows.collect()}

    from math import log
    need = target_entropy * log(count)
    ends = measure([0.0, 1.0])
    fits_entropy, fits_repeats = ends[1.0][0] >= need, ends[0.0][1] <= max_repeats
    if fits_entropy:
        lo[0] = 1.0
    if fits_repeats:
        hi[1] = 0.0
    for _ in range(PASSES):
        grid = [midpoints(lo[0], hi[0]), midpoints(lo[1], hi[1])]
        got = measure(sorted({a for g in grid for a in g}))
        for side, holds in ((0, lambda a: got[a][0] >= need), (1, lambda a: got[a][1] <= max_repeats)):
            for _level in range(LEVELS):
                if lo[side] == hi[side]:
                    break
                mid = min(grid[side], key=lambda a: abs(a - (lo[side] + hi[side]) / 2))
                if holds(mid) == (side == 0):
                    lo[side] = mid
                else:
                    hi[side] = mid
    return max(lo[0], hi[1])


def plan_mix(docs: DataFrame, id_col: str, text_col: str, source_col: str, target_entropy: float,
             max_repeats: float, budget: float, block_tokens: int) -> DataFrame:
    """One row per source: tokens, weight, quota, blocks, epochs and where the last epoch ends."""
    rows = write_table(
        docs.select(source_key(F.col(source_col)).alias("mix_source"), F.col(id_col).cast("long").alias("doc_id"),
                    doc_key(id_col, text_col)[1], n_words(F.col(text_col)).alias("n_tokens")).filter("n_tokens > 0"), "mix-rows")
    sums = write_table(rows.groupBy("mix_source").agg(F.sum("n_tokens").alias("tokens")), "mix-sources")
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    shares = sums.withColumn("p", F.col("tokens") / F.lit(float(total or 1)))
    a = find_exponent(shares, target_entropy, max_repeats, budget)
    z = shares.agg(F.sum(F.pow("p", F.lit(a)))).first()[0] or 1.0
    plan = (shares.withColumn("weight", F.pow("p", F.lit(a)) / F.lit(z))
            .withColumn("quota", F.floor(F.col("weight") * F.lit(float(total) * budget)).cast("long"))
            .withColumn("blocks", F.ceil(F.col("tokens") / F.lit(block_tokens)).cast("long"))
            .withColumn("epochs", F.floor(F.col("quota") / F.col("tokens")).cast("long"))
            .withColumn("rest", F.col("quota") - F.col("epochs") * F.col("tokens")))
    plan = write_table(plan, "mix-plan")

    last = (rows.join(plan.filter("rest > 0").select("mix_source", "epochs", "blocks", "rest"), "mix_source")
            .withColumn("h", deal(F.col("doc_id"), F.col("epochs")))
            .withColumn("block", F.pmod("h", "blocks")))
    by_block = Window.partitionBy("mix_source").orderBy("block")
    ends = write_table(last.groupBy("mix_source", "block", "rest").agg(F.sum("n_tokens").alias("n"))
            .withColumn("upto", F.sum("n").over(by_block))
            .filter("upto - n < rest and upto >= rest")
            .select("mix_source", F.col("block").alias("end_block"), (F.col("rest") - F.col("upto") + F.col("n")).alias("room")), "mix-ends")
    place = F.struct("h", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key_id"), "key_text")
    in_block = Window.partitionBy("mix_source").orderBy("place")
    stop = (last.join(ends, "mix_source").filter("block = end_block").withColumn("place", place)
            .groupBy("mix_source", "end_block", "room", "place").agg(F.sum("n_tokens").alias("n"))
            .withColumn("before", F.sum("n").over(in_block) - F.col("n")).filter("before < room")
            .groupBy("mix_source", "end_block").agg(F.max("place").alias("end_place")))
    return write_table(plan.join(stop, "mix_source", "left"), "mix-plan")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS, budget: float = BUDGET,
        block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The mix: every document once per epoch it is used in, with ``n_tokens, epoch, block, turn``.

    ``turn`` (0 to 1) is how far into its source's quota a block comes: read in its order,
    every stretch of the mix has the target weights. The plan has one row per source; whether
    it is broadcast is left to Spark's check of its size.
    """
    plan = plan_mix(docs, id_col, text_col, source_col, target_entropy, max_repeats, budget, block_tokens)
    plan = plan.select("mix_source", F.struct("tokens", "quota", "blocks", "epochs", "end_block", "end_place").alias("mix_plan"))
    new = ("n_tokens", "epoch", "block", "turn")
    kept = [c for c in docs.columns if c.lower() not in new]
    rows = (docs.select(F.struct(*kept).alias("row"), source_key(F.col(source_col)).alias("mix_source"),
                        *[c.alias(n) for c, n in zip(doc_key(id_col, text_col), ("mix_id", "mix_text"))],
                        F.col(id_col).cast("long").alias("deal_id"), n_words(F.col(text_col)).alias("n_tokens"))
            .filter("n_tokens > 0").join(plan, "mix_source"))
    rows = (rows.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mix_plan.epochs"))))
            .withColumn("h", deal(F.col("deal_id"), F.col("epoch")))
            .withColumn("block", F.pmod(F.col("h"), F.col("mix_plan.blocks"))))
    place = F.struct(F.col("h"), F.col("mix_id").alias("key_id"), F.col("mix_text").alias("key_text"))
    taken = ((F.col("epoch") < F.col("mix_plan.epochs")) | (F.col("block") < F.col("mix_plan.end_block"))
             | ((F.col("block") == F.col("mix_plan.end_block")) & (place <= F.col("mix_plan.end_place"))))
    turn = ((F.col("epoch") + F.col("block") / F.col("mix_plan.blocks"))
            / (F.col("mix_plan.quota") / F.col("mix_plan.tokens")))       # blocks differ a little in size
    return rows.filter(taken).select("row.*", "n_tokens", "epoch", "block", F.least(turn, F.lit(1.0)).alias("turn"))
