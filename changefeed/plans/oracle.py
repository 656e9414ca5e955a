"""DuckDB oracle SQL for the registered queries.

The expected rows come straight from the ``events`` columns: the feed
rules are residues of ``event_id`` and the JSON text is assembled by
concatenation, so no JSON is parsed on this side.
"""

from __future__ import annotations

# Object text of an event without ``meta`` ('{"id":...}'), and with it.
_REST = r"""'{"id":' || event_id || ',"type":"' || event_type || '","namespace":' || (user_id % 16)
  || ',"title":"Page ' || user_id || '","comment":"' || replace(props, '"', '\"')
  || '","timestamp":' || CAST(epoch(date_trunc('second', ts)) AS BIGINT) || ',"user":"user' || user_id
  || '","bot":' || CASE WHEN event_id % 5 = 0 THEN 'true' ELSE 'false' END
  || ',"server_name":"' || event_type || '.example.org","length":{"new":' || CAST(floor(value) AS INTEGER)
  || CASE WHEN event_id % 7 = 0 THEN '' ELSE ',"old":' || (event_id % 1000) END || '}}'"""

_OBJ = f"""WITH r AS (SELECT *, {_REST} AS rest FROM events),
o AS (SELECT *, '{{"meta":{{"domain":"' || event_type || '.example.org"}},' || substr(rest, 2) AS obj FROM r)"""

# Data lines (keep-alives and lines without the space are not).
_DATA = "event_id % 97 <> 0 AND event_id % 89 <> 0"
# Forwarded by ingest.
_VALID = f"{_DATA} AND event_id % 83 <> 0 AND event_id % 79 <> 0 AND event_id % 73 <> 0"
_DOMAIN = "CASE WHEN event_id % 71 <> 0 THEN event_type || '.example.org' END"

_PAYLOAD = """CASE WHEN event_id % 83 = 0 THEN substr(obj, 1, 20)
            WHEN event_id % 79 = 0 THEN '[1]'
            WHEN event_id % 73 = 0 THEN '{"meta":null,' || substr(rest, 2)
            WHEN event_id % 71 = 0 THEN rest
            ELSE obj END"""


def _flat(where: str, bad: str = "FALSE", domain: str = _DOMAIN) -> str:
    """The 11 flat columns; rows where ``bad`` holds are all null."""
    def ok(expr: str) -> str:
        return f"CASE WHEN NOT ({bad}) THEN {expr} END"
    return f"""SELECT {ok('event_id')} AS event_id, {ok('event_type')} AS event_type,
       {ok("'Page ' || user_id")} AS page_title, {ok('props')} AS comment,
       {ok("strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S')")} AS event_timestamp,
       {ok("'user' || user_id")} AS "user", {ok('event_id % 5 = 0')} AS bot,
       {ok(domain)} AS "domain",
       {ok("event_type || '.example.org'")} AS server_name,
       {ok('CAST(floor(value) AS INTEGER)')} AS new_length,
       {ok('CASE WHEN event_id % 7 <> 0 THEN CAST(event_id % 1000 AS INTEGER) END')} AS old_length
FROM events WHERE {where}"""


_CHANGES = _flat(_VALID)
_COUNTS = f"""SELECT "domain", count(*) AS edit_count FROM ({_CHANGES}) c GROUP BY 1"""

_REJECTS = f"""{_OBJ} SELECT {_PAYLOAD} AS payload,
        CASE WHEN event_id % 83 = 0 THEN 'invalid_json'
             WHEN event_id % 79 = 0 THEN 'not_object'
             ELSE 'meta_not_object' END AS reason
        FROM o WHERE {_DATA} AND (event_id % 83 = 0 OR event_id % 79 = 0 OR event_id % 73 = 0)"""

ORACLE_SQL: dict[str, str] = {
    "feed_data_lines": f"{_OBJ} SELECT {_PAYLOAD} AS payload FROM o WHERE {_DATA}",
    "landed_feed_lines": f"{_OBJ} SELECT {_PAYLOAD} AS payload FROM o WHERE {_DATA}",
    "ingest_valid": f"SELECT event_id, {_DOMAIN} AS \"domain\" FROM events WHERE {_VALID}",
    "ingest_allowlist": f"""SELECT event_id, {_DOMAIN} AS "domain" FROM events
        WHERE {_VALID} AND {_DOMAIN} IN ('click.example.org', 'view.example.org')""",
    "ingest_keyed": f"""SELECT coalesce({_DOMAIN}, 'default_domain') AS "key", count(*) AS record_count
        FROM events WHERE {_VALID} GROUP BY 1""",
    "ingest_rejects": _REJECTS,
    "stream_ingest_rejects": _REJECTS,
    "changes_flat": _CHANGES,
    "domain_edit_counts": _COUNTS,
    "page_domain_counts": """SELECT regexp_extract(url, '^https?://([^/:?#]+)', 1) AS "domain",
        count(*) AS edit_count FROM pages GROUP BY 1""",
    "source_domain_counts": """SELECT source AS "domain", count(*) AS edit_count FROM documents GROUP BY 1""",
    "summary_overwrite_twice": _COUNTS,
    "end_to_end_summary": _COUNTS,
    "stream_changes_append": _CHANGES,
    "stream_restart_no_duplicates": _CHANGES,
    "parse_permissive_nulls": _flat(
        _DATA, bad="event_id % 83 = 0 OR event_id % 79 = 0",
        domain="CASE WHEN event_id % 73 <> 0 AND event_id % 71 <> 0 THEN event_type || '.example.org' END"),
    "parse_quarantine_kept": _flat(
        f"{_DATA} AND event_id % 83 <> 0 AND event_id % 79 <> 0",
        domain="CASE WHEN event_id % 73 <> 0 AND event_id % 71 <> 0 THEN event_type || '.example.org' END"),
    "json_events_flat": _flat(
        f"{_DATA} AND event_id % 83 <> 0 AND event_id % 79 <> 0",
        domain="CASE WHEN event_id % 73 <> 0 AND event_id % 71 <> 0 THEN event_type || '.example.org' END"),
    "parse_quarantine_rejected": f"""{_OBJ} SELECT {_PAYLOAD} AS payload FROM o
        WHERE {_DATA} AND (event_id % 83 = 0 OR event_id % 79 = 0)""",
    "stream_empty_batch": _CHANGES,
    "stream_changes_batches": _CHANGES,
    "stream_processing_time": _CHANGES,
    "stream_quarantine_kept": _flat(
        f"{_DATA} AND event_id % 83 <> 0 AND event_id % 79 <> 0",
        domain="CASE WHEN event_id % 73 <> 0 AND event_id % 71 <> 0 THEN event_type || '.example.org' END"),
    "stream_quarantine_rejected": f"""{_OBJ} SELECT {_PAYLOAD} AS payload FROM o
        WHERE {_DATA} AND (event_id % 83 = 0 OR event_id % 79 = 0)""",
    "batch_row_metrics": f"SELECT count(*) AS n FROM events WHERE {_VALID}",
    "preview_rows": f"""SELECT least(count(*), 5) AS n_shown, least(count(*), 5) AS n_known,
        count(*) AS n_rows FROM events WHERE {_VALID}""",
    "catalog_tables_summary": _COUNTS,
    "summary_order": f"""SELECT *, row_number() OVER (ORDER BY edit_count DESC, "domain" NULLS FIRST) AS place
        FROM ({_COUNTS}) s""",
    "durable_batch_counts": f"""SELECT 'records' AS output, count(*) AS n_rows FROM events WHERE {_VALID}
        UNION ALL SELECT 'rejects', count(*) FROM ({_REJECTS}) r""",
    "stream_tip_start": _flat(f"{_VALID} AND event_id % 3 <> 0"),
    "ingest_record_order": f"""{_OBJ} SELECT coalesce({_DOMAIN}, 'default_domain') AS "key", {_PAYLOAD} AS payload,
        CAST(event_id % 4 AS BIGINT) AS batch_id FROM o WHERE {_VALID}""",
    "summary_by_commits": _COUNTS,
    "stream_batch_preview": f"""SELECT least(count(*), 5) AS n_known, count(*) AS n_counted, count(*) AS n_rows
        FROM events WHERE {_VALID}""",
    "app_settings_run": _COUNTS,
    "stream_until_stopped": _CHANGES,
    "ingest_records": f"""{_OBJ} SELECT coalesce({_DOMAIN}, 'default_domain') AS "key", {_PAYLOAD} AS payload
        FROM o WHERE {_VALID}""",
}
