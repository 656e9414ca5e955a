"""Training-data operators: extraction, filtering, fingerprints, scoring, packing.

Nothing else in the library imports this subpackage.  Every operator takes
and returns DataFrames; the registered ``opN_*`` queries are thin and live in
:mod:`changefeed.llm.queries`.
"""
