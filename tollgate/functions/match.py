"""Regex rule matching.

Rule tables are configuration (tens to thousands of patterns). Up to ``INLINE_RULES`` rows each
pattern becomes a *literal* regex of its own in one flat ``coalesce``: Spark compiles it once per
task, evaluation stops at the first hit, and neither depth nor the meaning of a pattern
(back references, group names) depends on how many rules there are.

A larger table stays a table, and its patterns are found by an *inverted index*. Most patterns contain a
literal that every match must contain, too (``.*/query/a\\.do.*`` has ``/query/a.do``). The index holds one
short piece (gram) of each pattern's literal, the one that the fewest patterns share. Texts meet the patterns whose gram they
contain in an equi-join on the gram, and ``rlike`` verifies. The rare patterns without such a literal (``.*``,
alternatives at the top) are a list that every text is tested against, in blocks of literal expressions.
Results are the same on either way; a null pattern matches nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INLINE_RULES = 256     # rules compiled into an expression; more are joined as a table
GRAMS = (4, 2)         # lengths of index grams: the first that fits into a pattern's literal
BLOCK = 200            # patterns without a literal that are tested in one expression


def full_pattern(pattern: str) -> str:
    """Java ``String.matches`` semantics: the whole input must match.

    ``\\z`` (not ``$``) so a trailing newline is not forgiven.
    """
    return f"^(?:{pattern})\\z"


def full_match(c: Column, pattern: str) -> Column:
    return c.rlike(full_pattern(pattern))


def any_full_match(c: Column, patterns: list[str]) -> Column:
    """True when ``c`` fully matches at least one pattern (False for no patterns, or a null text)."""
    return F.coalesce(*[F.when(full_match(c, p), F.lit(True)) for p in patterns if p is not None], F.lit(False))


def first_match_value(c: Column, cases: list[tuple[str, Column]], default: Column) -> Column:
    """Value of the first (pattern, value) whose pattern fully matches ``c``; values are not null."""
    return F.coalesce(*[F.when(full_match(c, p), v) for p, v in cases if p is not None], default)


def inline_rules(df: DataFrame, *cols: str, order_by: str | None = None, limit: int | None = None) -> list[tuple] | None:
    """Rows of a rule table that is small enough to be compiled into an expression, else None; one small job."""
    limit = INLINE_RULES if limit is None else limit
    names = [*cols, *([order_by] if order_by and order_by not in cols else [])]
    rows = df.select(*names).limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    if order_by:
        rows.sort(key=lambda r: (r[order_by] is not None, r[order_by]))
    return [tuple(r[c] for c in cols) for r in rows]


# ---- the index of a large table -------------------------------------------------------------------

# Pieces of a Java pattern: quoted text, an escape, a class, a quantifier, or one character.
_TOKENS = r"(?s)\\Q.*?(?:\\E|\z)|\\.|\[\^?(?:\\.|[^\]\\])*\]|[*+?][+?]?|\{\d+(?:,\d*)?\}[+?]?|."
_PLAIN_ESCAPE = r"^\\[^A-Za-z0-9]$"                     # a character that is not meant as an operator
_SHORT_ESCAPE = r"^\\[dDwWsSbBhHvVRtnrfeazZAG]$"        # one character of some kind, or none


def required_literal(pattern: Column) -> Column:
    """The longest literal that every text matching ``pattern`` contains; null where none is certain.

    One scan over the pattern's pieces. Groups count as unknown, an optional character is left out;
    what the scan does not know for certain (flags, nested classes, coded characters, alternatives
    outside groups) gives null. A literal is never wrong, it may be shorter than it could be.
    """
    pieces = F.regexp_extract_all(pattern, F.lit(_TOKENS), 0)
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("run"), F.lit("").alias("best"), F.lit(True).alias("sure"))

    def longer(run: Column, best: Column) -> Column:
        return F.when(F.length(run) > F.length(best), run).otherwise(best)

    def read(s: Column, t: Column) -> Column:
        first, run = F.substring(t, 1, 1), s["run"]
        quantifier = first.isin("*", "+", "?") | ((first == "{") & (F.length(t) > 1))
        plain = t.rlike(_PLAIN_ESCAPE)
        operator = first.isin("(", ")", "|", ".", "^", "$", "[", "]", "{", "}", "\\") & ~plain
        literal = ~quantifier & ~operator
        outside = s["depth"] == 0
        optional = t.startswith("*") | t.startswith("?") | t.startswith("{0")
        kept = F.when(quantifier & optional & outside, F.substring(run, F.lit(1), F.greatest(F.length(run) - 1, F.lit(0)))).otherwise(run)
        char = F.when(plain, F.substring(t, 2, 1)).otherwise(t)
        unsure = (((t == "|") & outside) | ((t == ")") & outside) | t.isin("[", "]", "{", "}", "\\") | t.startswith("\\Q")
                  | ((first == "[") & F.substring(t, F.lit(2), F.length(t)).contains("["))
                  | ((first == "\\") & ~plain & ~t.rlike(_SHORT_ESCAPE)))
        return F.struct((s["depth"] + F.when(t == "(", 1).when(t == ")", -1).otherwise(0)).alias("depth"),
                        F.when(literal & outside, F.concat(run, char)).otherwise(F.lit("")).alias("run"),
                        F.when(literal, s["best"]).otherwise(longer(kept, s["best"])).alias("best"),
                        (s["sure"] & ~unsure).alias("sure"))

    def done(s: Column) -> Column:
        return F.when(s["sure"] & (s["depth"] == 0), F.nullif(longer(s["run"], s["best"]), F.lit("")))
    return F.when(~pattern.rlike(r"\(\?[^:]"), F.aggregate(pieces, start, read, done))


def grams(text: Column, width: int) -> Column:
    """All pieces of ``width`` characters; none of a shorter text."""
    return F.when(F.length(text) >= width, F.transform(F.sequence(F.lit(1), F.length(text) - width + 1),
                                                       lambda i: F.substring(text, i, F.lit(width)))).otherwise(F.array().cast("array<string>"))


def pattern_index(patterns: DataFrame) -> DataFrame:
    """(pattern, gram): for each different ``pattern`` its rarest gram, null where it has no literal."""
    known = patterns.select("pattern").where("pattern IS NOT NULL").distinct().withColumn("literal", required_literal(F.col("pattern")))
    own = F.coalesce(*[F.nullif(grams(F.col("literal"), w), F.array().cast("array<string>")) for w in GRAMS])
    each = known.select("pattern", F.explode_outer(F.array_distinct(own)).alias("gram"))
    shared = each.where("gram IS NOT NULL").groupBy("gram").agg(F.count(F.lit(1)).alias("patterns"))
    return each.join(shared, "gram", "left").groupBy("pattern").agg(F.min_by("gram", F.struct("patterns", "gram")).alias("gram"))


def matching_patterns(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(text, pattern): which different ``text`` fully matches which different ``pattern``."""
    index = pattern_index(patterns)
    pieces = F.array_distinct(F.concat(*[grams(F.col("text"), w) for w in GRAMS]))
    candidates = texts.select("text", F.explode(pieces).alias("gram")).join(index.where("gram IS NOT NULL"), "gram")
    found = [candidates.where(F.expr("text RLIKE concat('^(?:', pattern, ')\\\\z')")).select("text", "pattern")]
    rest = [r[0] for r in index.where("gram IS NULL").select("pattern").collect()]
    for k in range(0, len(rest), BLOCK):
        hits = F.array(*[F.when(full_match(F.col("text"), p), F.lit(p)) for p in rest[k:k + BLOCK]])
        found.append(texts.select("text", F.explode(F.array_compact(hits)).alias("pattern")))
    return reduce(DataFrame.union, found)


def match_by_index(df: DataFrame, text_col: str, rules: DataFrame, pattern_col: str, best: Column, out: str,
                   equal: dict[str, str] | None = None) -> DataFrame:
    """``df`` with ``out`` = the aggregate ``best`` over the rules each text matches, null if none.

    One row per different text meets the rules, so repeated texts cost nothing; ``best`` is a
    map-side aggregate (``min_by``, ``max_by``, ``count``), so no list of matches is built.
    ``equal`` names columns of ``df`` that must equal a column of the rule, too.
    """
    equal = equal or {}
    keys = ["_text", *[f"_equal_{k}" for k in range(len(equal))]]
    own = [F.col(text_col).alias("_text"), *[F.col(c).alias(k) for c, k in zip(equal, keys[1:])]]
    asked = df.select(*own).where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])).distinct()
    rules = rules.select("*", F.col(pattern_col).alias("_pattern"), *[F.col(c).alias(k) for c, k in zip(equal.values(), keys[1:])])
    pairs = matching_patterns(asked.select(F.col("_text").alias("text")).distinct(), rules.select(F.col("_pattern").alias("pattern")))
    pairs = pairs.select(F.col("text").alias("_text"), F.col("pattern").alias("_pattern"))
    hits = (pairs.join(rules, "_pattern").join(asked, keys).groupBy(*keys).agg(best.alias(out)))
    wide = df.select("*", *own)
    return wide.join(hits, keys, "left").select(*df.columns, out)


def flag_any_match(df: DataFrame, text_col: str, rules: DataFrame, pattern_col: str, out: str) -> DataFrame:
    """``df`` with the boolean ``out``: the text fully matches at least one rule."""
    small = inline_rules(rules, pattern_col)
    if small is not None:
        return df.withColumn(out, any_full_match(F.col(text_col), [r[0] for r in small]))
    joined = match_by_index(df, text_col, rules.select(pattern_col), pattern_col, F.count(F.lit(1)), out)
    return joined.withColumn(out, F.col(out).isNotNull())
