"""Personal-data redaction: each match is replaced by its upper-hex MD5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mobile-number pattern (unanchored, as deployed: it also rewrites
# 11-digit runs inside timestamps) and the identity-card pattern.
PHONE_PATTERN = r"((13[0-9])|(14[5|7])|(15([0-3]|[5-9]))|(17[0-9])|(18[0,5-9]))\d{8}"
ID_CARD_PATTERN = r"(\d{18})|(\d{17}(\d|X|x))|(\d{15})"
# Bounded variant: digits not embedded in a longer digit run.
PHONE_PATTERN_BOUNDED = r"(?<![0-9])" + PHONE_PATTERN + r"(?![0-9])"


def md5_upper(c: Column) -> Column:
    return F.upper(F.md5(c))


def md5_nonempty(c: Column) -> Column:
    """MD5 of a non-empty value; empty or NULL stays NULL."""
    return F.when(F.length(c) > 0, md5_upper(c))


def redact(c: Column, pattern: str) -> Column:
    """Replace every match found in the original text by its MD5 (all occurrences)."""
    return F.aggregate(F.regexp_extract_all(c, F.lit(pattern), 0), c,
                       lambda acc, m: F.replace(acc, m, md5_upper(m)))


def redact_phone(c: Column, bounded: bool = False) -> Column:
    return redact(c, PHONE_PATTERN_BOUNDED if bounded else PHONE_PATTERN)


def redact_id_card(c: Column) -> Column:
    return redact(c, ID_CARD_PATTERN)


def hash_each(arr: Column) -> Column:
    return F.transform(arr, lambda x: md5_upper(x))
