"""DataFrame -> DataFrame operators: ingest, parse/flatten, summaries."""

from changefeed.operators.aggregates import domain_counts, ranked
from changefeed.operators.evaluation import once
from changefeed.operators.ingest import (
    REASONS,
    classify,
    filter_domains,
    frame,
    keyed,
    prefilter_domains,
    rejects,
    valid,
)
from changefeed.operators.partitioning import spread
from changefeed.operators.recentchange import (
    domains,
    flatten,
    malformed,
    parse,
    parse_records,
    reads_as_object,
    well_formed,
)

__all__ = [
    "REASONS",
    "classify",
    "domain_counts",
    "domains",
    "filter_domains",
    "flatten",
    "frame",
    "keyed",
    "malformed",
    "once",
    "parse",
    "parse_records",
    "prefilter_domains",
    "ranked",
    "reads_as_object",
    "rejects",
    "spread",
    "valid",
    "well_formed",
]
