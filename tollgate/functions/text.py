"""Per-field scalar builders (URL, cookie, decode, time, IP, route)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cookie keys holding the session id and the user id.
SESSION_COOKIE_KEY = "JSESSIONID"
USER_COOKIE_KEY = "userId4logCookie"
MISSING = "NULL"


def url_path(request: Column) -> Column:
    """``METHOD url HTTP/x`` -> url (NULL when the line has no space)."""
    return F.get(F.split(request, " "), 1)


def unescape_percent_u(c: Column) -> Column:
    """Browser ``escape()`` decoding: ``%uXXXX`` -> UTF-16 unit, ``%XX`` -> Latin-1 char.

    ``+`` is kept as is (unlike URL decoding).
    """
    # One pass from left to right: what a token decodes to is never read again. A run of
    # %uXXXX is one token, so that surrogate pairs stay together.
    tokens = F.regexp_extract_all(c, F.lit("(?s)(?:%u[0-9a-fA-F]{4})+|%[0-9a-fA-F]{2}|[^%]+|%"), 0)
    decoded = F.transform(tokens, lambda t: F.when(
        t.startswith("%u") & (F.length(t) > 2), F.decode(F.unhex(F.replace(t, F.lit("%u"), F.lit(""))), "UTF-16BE"))
        .when(t.startswith("%") & (F.length(t) == 3), F.decode(F.unhex(F.substring(t, 2, 2)), "ISO-8859-1"))
        .otherwise(t))
    return F.when(c.isNotNull(), F.array_join(decoded, ""))


def decode_value(c: Column) -> Column:
    """Value decoding of cookies: escape()-style when it holds ``uXXXX``, URL decoding
    otherwise; malformed input gives NULL (the pair is dropped)."""
    return F.when(c.rlike("u[0-9a-fA-F]{4}"), unescape_percent_u(c)).otherwise(F.try_url_decode(c))


def kv_map(text: Column, pair_sep: str, decode: Callable[[Column], Column] | None = None) -> Column:
    """``k=v<sep>k=v`` -> MAP<STRING,STRING>, with ``String.split`` semantics.

    A pair is kept when its ``=``-split has a non-empty part after the key
    (trailing empty parts do not count), and its value is the second part (so
    ``a==b`` gives ``a -> ''`` and ``a=x=y`` gives ``a -> x``; ``a`` and ``a=``
    are skipped). Keys are trimmed; the last occurrence of a key wins (session
    ``mapKeyDedupPolicy``); a value that fails to decode drops its pair.
    """
    pieces = F.split(F.coalesce(text, F.lit("")), pair_sep)
    entries = F.transform(pieces, lambda p: F.split(p, "="))
    entries = F.filter(entries, lambda kv: F.exists(F.slice(kv, 2, F.greatest(F.size(kv), F.lit(1))),
                                                     lambda x: F.length(x) > 0))
    entries = F.transform(entries, lambda kv: F.struct(F.trim(F.get(kv, 0)).alias("key"),
                                                       F.get(kv, 1).alias("raw")))
    if decode:
        entries = F.transform(entries, lambda e: F.struct(e["key"].alias("key"),
                                                          decode(e["raw"]).alias("value")))
        entries = F.filter(entries, lambda e: e["value"].isNotNull())
    else:
        entries = F.transform(entries, lambda e: F.struct(e["key"].alias("key"), e["raw"].alias("value")))
    return F.map_from_entries(entries)


def cookie_map(cookie: Column) -> Column:
    return kv_map(cookie, ";", decode_value)


def form_map(body: Column) -> Column:
    """Form body -> map; values are URL-decoded (never escape()-style)."""
    return kv_map(body, "&", F.try_url_decode)


XML_ROOT = "doc"


def xml_doc(body: Column) -> Column:
    """XML text from its first ``<page>`` on, inside a root of ours; NULL if it does not parse.

    ``xpath`` functions abort the job on malformed input, so the permissive XML reader looks at
    the text first. The root makes trailing text or a second document part of the same one.
    """
    from_page = F.when(F.instr(body, "<page>") > 0, F.substr(body, F.instr(body, "<page>"))) \
        .otherwise(F.regexp_replace(body, r"^\s*<\?xml[^>]*\?>", ""))
    text = F.concat(F.lit(f"<{XML_ROOT}>"), from_page, F.lit(f"</{XML_ROOT}>"))
    seen = F.from_xml(text, "_malformed string", {"columnNameOfCorruptRecord": "_malformed", "mode": "PERMISSIVE"})
    return F.when((F.length(F.trim(from_page)) > 0) & seen["_malformed"].isNull(), text)


def xml_path(path: str) -> str:
    """An XPath of the document as one below our root."""
    return f"/{XML_ROOT}{path}" if path.startswith("/") and not path.startswith("//") else path


def cookie_value(cmap: Column, key: str) -> Column:
    """Look a cookie up, ``'NULL'`` when absent (the record's missing marker)."""
    return F.coalesce(F.element_at(cmap, F.lit(key)), F.lit(MISSING))


# Date and time, then an optional fraction and an optional offset; what follows is ignored.
ISO_TIME = r"^\s*(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})(?:[.,](\d{1,6})\d*)?(Z|[+-]\d{2}(?::?\d{2})?)?"


def iso_to_ts(c: Column) -> Column:
    """ISO-8601 text -> timestamp; without an offset it is UTC; NULL when unparsable."""
    part = [F.regexp_extract(c, ISO_TIME, i) for i in range(4)]
    offset = F.regexp_replace(part[3], r"^([+-]\d{2}):?(\d{2})?$", "$1:$2")
    offset = F.when(part[3].isin("", "Z"), F.lit("Z")).when(offset.endswith(":"), F.concat(offset, F.lit("00"))).otherwise(offset)
    fraction = F.when(part[2] != "", F.concat(F.lit("."), part[2])).otherwise(F.lit(""))
    return F.when(part[1] != "", F.concat(F.replace(part[1], F.lit("T"), F.lit(" ")), fraction, offset).try_cast("timestamp"))


def iso_to_millis(c: Column) -> Column:
    return F.unix_millis(iso_to_ts(c))


def format_batch_time(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def ip_block(ip: Column) -> Column:
    """``a.b.c.d`` -> ``a.b`` (the /16 block)."""
    return F.substring_index(ip, ".", 2)


def is_ipv4_shape(ip: Column) -> Column:
    """Exactly four dot-separated parts (trailing empty parts do not count)."""
    return F.size(F.split(F.regexp_replace(ip, "[.]+$", ""), "[.]")) == 4


def route(dep: Column, arr: Column) -> Column:
    return F.concat(dep, F.lit("->"), arr)
