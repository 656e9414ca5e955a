"""Sources: feed lines, keyed record streams, tables."""

from changefeed.sources.eventfeed import render_feed
from changefeed.sources.feed import feed_lines
from changefeed.sources.jsonfiles import json_events
from changefeed.sources.records import read_records, record_stream
from changefeed.sources.tables import table

__all__ = ["feed_lines", "json_events", "read_records", "record_stream", "render_feed", "table"]
