"""Write the physical plans of the headline queries to PLANS.md.

    python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from changefeed.plans.queries import QUERIES  # noqa: E402
from changefeed.session import build_session  # noqa: E402

SHOWN = ["ingest_keyed", "ingest_allowlist", "changes_flat", "domain_edit_counts",
         "page_domain_counts", "source_domain_counts"]
WIDTH = 220

NOTES = {
    "ingest_keyed": "The round-robin Exchange spreads the one-row-group test table over the "
                    "cores; a large input skips it. One Generate parses each payload, one parses "
                    "the small `meta` text, and the validity Filter sits above both. The per-key count "
                    "is a partial count, one hash Exchange, then a final count.",
    "ingest_allowlist": "The raw-text pre-test (`Contains(..., \\u)` or a listed domain) runs "
                        "before the first JSON parse; the exact `IN` test runs after it.",
    "changes_flat": "The typed `from_json` runs in its own Project; the flat columns are read "
                    "from its result.",
    "domain_edit_counts": "The typed parse is narrowed to `meta.domain`; `partial_count` runs "
                          "before the hash Exchange, so each task ships one row per domain; the "
                          "range Exchange for the sort sees only the aggregated rows.",
    "page_domain_counts": "The scan reads only `url` (`ReadSchema`).",
    "source_domain_counts": "The scan reads only `source`; the 20,000-word `text` column is "
                            "never read.",
}


def formatted(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    lines = []
    for line in buf.getvalue().splitlines():
        lines.append(line if len(line) <= WIDTH else line[:WIDTH] + " ...")
    return "\n".join(lines).strip()


def streaming_section(spark, sf_dir: str) -> list[str]:
    """Run the changes stream once over keyed records and show its last
    micro-batch plan."""
    from changefeed.plans import jobs
    from changefeed.plans.queries import _lines
    from changefeed.session import shared_dir
    from changefeed.sinks import write_records
    from changefeed.streaming import run_bounded

    base = shared_dir(spark, "plans-stream")
    write_records(jobs.ingest(_lines(spark, sf_dir)), path=f"{base}/records")
    (query,) = jobs.stream_changes(spark, f"{base}/_ckpt", source_path=f"{base}/records",
                                   path=f"{base}/out", trigger="available_now", time_zone="UTC")
    run_bounded(query)
    buf = io.StringIO()
    with redirect_stdout(buf):
        query.explain()
    text = "\n".join(ln if len(ln) <= WIDTH else ln[:WIDTH] + " ..."
                     for ln in buf.getvalue().splitlines()).strip()
    return ["## stream_changes (one micro-batch)", "",
            "The streaming job's executed plan: file source of keyed records, decode, one typed "
            "parse, flatten and the observed row count (`CollectMetrics`); the rows go to the "
            "file sink. It has no shuffle and no state.", "", "```", text, "```", ""]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("changefeed-plans", "local[8]", {"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans", "",
           f"`explain(\"formatted\")` of the headline queries over `{sf_dir}`, before execution",
           "(the adaptive plan may still coalesce shuffle partitions at run time). Long",
           f"expression lines are cut at {WIDTH} characters. Regenerate with",
           "`python tools/explain_plans.py`.", ""]
    for name in SHOWN:
        out += [f"## {name}", "", QUERIES[name].__doc__.strip(), "", NOTES[name], "", "```",
                formatted(QUERIES[name](spark, sf_dir)), "```", ""]
    out += streaming_section(spark, sf_dir)
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
