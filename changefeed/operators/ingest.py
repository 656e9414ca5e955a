"""Ingest: feed lines -> validated, domain-filtered, keyed records.

Every step is a narrow transformation (no shuffle), so ingest runs at the
speed of the scan on any number of executors, batch or streaming.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.functions import (
    domain_is_not_text,
    is_data_line,
    json_elements,
    json_object,
    last_value,
    may_name_domain,
    meta_is_text,
    not_an_object,
    only_object,
    partition_key,
    strip_data_prefix,
)
from changefeed.operators.evaluation import once

# Why a data line was not forwarded.
INVALID_UTF8 = "invalid_utf8"
INVALID_JSON = "invalid_json"
NOT_OBJECT = "not_object"
META_NOT_OBJECT = "meta_not_object"
DOMAIN_NOT_STRING = "domain_not_string"
REASONS = (INVALID_UTF8, INVALID_JSON, NOT_OBJECT, META_NOT_OBJECT, DOMAIN_NOT_STRING)


def frame(lines: DataFrame, line_col: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """Keep event lines and strip their prefix: ``value`` -> ``payload``;
    ``keep``: further columns to carry along."""
    return lines.where(is_data_line(line_col)).select(
        strip_data_prefix(line_col).alias("payload"), *keep
    )


def classify(framed: DataFrame, payload_col: str = "payload", fields: Iterable[str] = ()) -> DataFrame:
    """Add ``domain`` and ``reason`` (null when the record is forwarded).

    A record is forwarded when its payload is valid UTF-8, one JSON object
    with nothing after it, its ``meta`` is absent or an object, and the
    domain in it is absent, null or a string.  The payload is parsed once
    into a string map; only the small ``meta`` text is parsed a second time.
    ``fields`` adds the text of further top-level fields from that parse.
    """
    payload = F.col(payload_col)
    m = F.col("_obj")
    has_meta = F.map_contains_key(m, "meta")
    meta_text = last_value(m, "meta")
    meta = F.col("_meta")
    domain = last_value(meta, "domain")
    reason = (
        F.when(~F.is_valid_utf8(payload), F.lit(INVALID_UTF8))
        .when(m.isNull() & not_an_object(payload), F.lit(NOT_OBJECT))
        .when(m.isNull(), F.lit(INVALID_JSON))
        .when(has_meta & (meta.isNull() | meta_is_text(payload)), F.lit(META_NOT_OBJECT))
        .when(domain_is_not_text(domain, meta_text), F.lit(DOMAIN_NOT_STRING))
    )
    parsed = once(framed, json_elements(payload), "_elements")
    parsed = once(parsed, only_object("_elements", payload), "_obj")
    parsed = once(parsed, F.when(has_meta, json_object(meta_text)), "_meta")
    return parsed.select(
        *[F.col(c) for c in framed.columns],
        *[last_value(m, f).alias(f) for f in fields],
        domain.alias("domain"),
        reason.alias("reason"),
    )


def valid(framed: DataFrame, payload_col: str = "payload", fields: Iterable[str] = ()) -> DataFrame:
    """Forwarded records: the framed columns plus ``fields`` and ``domain``."""
    return (
        classify(framed, payload_col, fields)
        .where(F.col("reason").isNull())
        .drop("reason")
    )


def rejects(framed: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Records that were not forwarded, with the ``reason``."""
    return classify(framed, payload_col).where(F.col("reason").isNotNull()).drop("domain")


def filter_domains(records: DataFrame, domains: Iterable[str] | None = None,
                   domain_col: str = "domain") -> DataFrame:
    """Allow-list by domain.  No list (or an empty one) keeps everything;
    with a list, records without a domain are dropped."""
    allowed = sorted(set(domains or ()))
    if not allowed:
        return records
    return records.where(F.col(domain_col).isin(allowed))


def prefilter_domains(framed: DataFrame, domains: Iterable[str] | None = None,
                      payload_col: str = "payload") -> DataFrame:
    """Drop, before any JSON parse, payloads that cannot name an allowed
    domain (see :func:`changefeed.functions.may_name_domain`).

    Exact: it only removes lines :func:`filter_domains` would drop anyway.
    Most lines of a busy feed are then never parsed, however long the list.
    """
    allowed = sorted(set(domains or ()))
    if not allowed:
        return framed
    return framed.where(may_name_domain(payload_col, allowed))


def keyed(records: DataFrame, payload_col: str = "payload",
          domain_col: str = "domain", keep: Iterable[str] = ()) -> DataFrame:
    """Key/value layout of a message-bus record: key = domain (or the
    default key), value = the whole JSON object as UTF-8 bytes; ``keep``:
    further columns to carry along."""
    return records.select(
        partition_key(domain_col).alias("key"),
        F.col(payload_col).cast("binary").alias("value"), *keep,
    )

