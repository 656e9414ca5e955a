"""Scalar column expressions for feed lines, payloads and summaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (they must stay as written for results to match):
#   a feed line carries an event only when it starts with "data: " (with the space);
#   an event with no meta.domain is keyed "default_domain";
#   an output time string has the form yyyy-MM-dd HH:mm:ss;
#   a page host is the first group of ^https?://([^/:?#]+) over its URL.
DATA_PREFIX = "data: "
DEFAULT_KEY = "default_domain"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
HOST_PATTERN = r"^https?://([^/:?#]+)"

# JSON reader limits: strings of any length are read whole (the reader's
# default stops at 20M characters), and so are numbers (default 1,000 digits).
# Nesting depth keeps its default, close to what a strict Python reader refuses.
JSON_READ_OPTIONS = {"maxStringLen": str(2**31 - 1), "maxNumLen": str(2**31 - 1)}

# Largest |epoch seconds| a microsecond timestamp holds, less two days of
# zone offset headroom.
_MAX_TS_SECONDS = (2**63 - 1) // 1_000_000 - 2 * 86400


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_data_line(line: str | Column) -> Column:
    """True for lines that carry an event (keep-alives, blanks and other
    event-stream fields such as ``event:`` or ``id:`` are not)."""
    return _c(line).startswith(DATA_PREFIX)


def strip_data_prefix(line: str | Column) -> Column:
    """The payload after the ``data: `` prefix."""
    return F.substr(_c(line), F.lit(len(DATA_PREFIX) + 1))


def decode_utf8(value: str | Column) -> Column:
    """Bytes -> string.  A JVM cast, not a Python decode."""
    return _c(value).cast("string")


def json_object(payload: str | Column) -> Column:
    """Parse a payload as a JSON object into ``map<string,string>``.

    Null when the text is not JSON or its top level is not an object.
    Nested values come back as their JSON text, scalars as their text.
    Single quotes are refused, as a strict JSON reader would.
    """
    return F.from_json(_c(payload), "map<string,string>",
                       {"allowSingleQuotes": "false", **JSON_READ_OPTIONS})


def _mark(payload: Column) -> Column:
    return F.xxhash64(payload).cast("string")


def json_elements(payload: str | Column) -> Column:
    """Parse a payload as the first element of an array of objects.

    The JSON reader stops after the first complete value, so a text such as
    ``{"id":8} trailing`` would parse.  Inside an array, closed by an element
    that marks this text, only a payload that is one whole object gives two
    elements with the mark as the second (see :func:`only_object`).
    """
    p = _c(payload)
    closed = F.concat(F.lit("["), p, F.lit(',{"":"'), _mark(p), F.lit('"}]'))
    return F.from_json(closed, "array<map<string,string>>",
                       {"allowSingleQuotes": "false", **JSON_READ_OPTIONS})


def only_object(elements: str | Column, payload: str | Column) -> Column:
    """The object of a payload parsed by :func:`json_elements`; null when the
    payload is anything but one JSON object."""
    e, p = _c(elements), _c(payload)
    whole = (F.size(e) == 2) & (F.get(e, F.lit(1))[""] == _mark(p))
    return F.when(whole & ~_has_odd_number(p), F.get(e, F.lit(0)))


def _has_odd_number(payload: Column) -> Column:
    """A number word that the JSON reader takes and a strict one does not
    (``+INF``, ``-INF``, ``+Infinity``); ``NaN`` and ``Infinity`` are fine in both."""
    may = payload.contains("INF") | payload.contains("+I") | payload.contains("+N")
    outside = F.regexp_replace(F.regexp_replace(payload, r"(?s)\\.", ""), '"[^"]*"', '""')
    return may & outside.rlike("INF|[+](Infinity|NaN)")


def last_value(m: str | Column, key: str) -> Column:
    """A map's value for ``key``, of repeated keys the last (as a strict
    reader and the typed parse take it)."""
    m = _c(m)
    keys = F.map_keys(m)
    back = F.array_position(F.reverse(keys), key).cast("int")
    return F.when(back > 0, F.get(F.map_values(m), F.size(keys) - back))


def meta_is_text(payload: str | Column) -> Column:
    """``meta`` is a JSON string (whose text may look like an object).

    Only a text that may hold such a string is parsed again: one with
    ``"meta"`` before a quote, or with an escape that may spell the key.
    """
    p = _c(payload)
    may = p.rlike(r'"meta"[ \t\r\n]*:[ \t\r\n]*"') | p.contains("\\u006") | p.contains("\\u007")
    typed = F.from_json(p, "struct<meta: map<string,string>>", JSON_READ_OPTIONS)["meta"]
    return may & typed.isNull()


def domain_is_not_text(domain: str | Column, meta_text: str | Column) -> Column:
    """``domain`` (its text form) was a JSON number, boolean, array or object."""
    d = _c(domain)
    may = d.rlike(r"^(-?[0-9]|[\[{]|true$|false$|NaN$|-?Infinity$)")
    kind = F.schema_of_variant(F.from_json(_c(meta_text), "struct<domain: variant>", JSON_READ_OPTIONS)["domain"])
    return may & F.coalesce(kind != "STRING", F.lit(True))


def not_an_object(payload: str | Column) -> Column:
    """Valid JSON whose top level is an array or a scalar (one value only)."""
    p = _c(payload)
    closed = F.concat(F.lit("["), p, F.lit(',"'), _mark(p), F.lit('"]'))
    values = F.try_parse_json(closed).cast("array<variant>")
    whole = (F.size(values) == 2) & (F.get(values, F.lit(1)).cast("string") == _mark(p))
    return F.coalesce(whole, F.lit(False))


#: Up to so many allowed domains are searched for one by one.
FEW_DOMAINS = 16


def may_name_domain(payload: str | Column, domains: list[str]) -> Column:
    """False only for payloads whose ``meta.domain`` cannot be any of
    ``domains`` -- a test on the raw text, before any parse.

    A JSON string equal to an allowed domain appears in the text literally
    unless some of its characters are escaped.  Letters, digits, dots and
    dashes can only be escaped as ``\\uXXXX``; the short escapes stand for
    quote, backslash, slash and control characters.  So a text with no
    listed domain and no ``\\u`` cannot match -- or no backslash at all, if
    a listed domain holds one of the short-escape characters.

    A short list is searched for domain by domain.  Beyond ``FEW_DOMAINS``
    the text values of keys spelled ``domain`` are looked up in a hash set of the
    list: one pass over the text whatever the list's length.
    """
    p = _c(payload)
    short_escaped = set('"\\/\b\f\n\r\t')
    escape = "\\" if any(ch in short_escaped for d in domains for ch in d) else "\\u"
    test = p.contains(escape)
    if len(domains) > FEW_DOMAINS:
        named = F.regexp_extract_all(p, F.lit(r'"domain"[ \t\r\n]*:[ \t\r\n]*"([^"\\]*)"'), F.lit(1))
        return test | F.exists(named, lambda d: d.isin(list(domains)))
    for d in domains:
        test = test | p.contains(d)
    return test


def partition_key(domain: str | Column) -> Column:
    """Record key: the domain, or ``default_domain`` when there is none."""
    return F.coalesce(_c(domain), F.lit(DEFAULT_KEY))


def epoch_to_string(seconds: str | Column, time_zone: str | None = None) -> Column:
    """Epoch seconds -> ``yyyy-MM-dd HH:mm:ss``.

    With no ``time_zone`` the string is in the session zone (the zone is
    bound when the DataFrame is analysed).  With one, the value is computed
    as a zone-free wall clock and converted, so the session zone does not
    matter.
    """
    seconds = _c(seconds)
    # Beyond what a timestamp holds (about +-292,000 years) the value is null
    # in either way, not a wrapped date or an error that fails the whole job.
    in_range = seconds.between(-_MAX_TS_SECONDS, _MAX_TS_SECONDS)
    if time_zone is None:
        return F.when(in_range, F.from_unixtime(seconds, TIME_FORMAT))
    utc_wall = F.timestamp_add("SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    wall = F.convert_timezone(F.lit("UTC"), F.lit(time_zone), utc_wall)
    return F.when(in_range, F.date_format(wall, TIME_FORMAT))


def url_host(url: str | Column) -> Column:
    """Host of an http(s) URL; empty string when the URL has none."""
    return F.regexp_extract(_c(url), HOST_PATTERN, 1)

