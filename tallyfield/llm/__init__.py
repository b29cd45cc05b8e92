"""Training-data operators: deduplication, search, mixing, scoring, extraction and encoding.

Nothing else in the library imports this subpackage.  ``queries.py`` holds the registered
queries, ``sql.py`` their DuckDB counterparts where SQL can express them.
"""
