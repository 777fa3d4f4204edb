"""Operators for preparing training corpora: one module per operator, queries in :mod:`geotrail.llm.queries`.

Nothing else in the library imports this subpackage. Every operator takes a
DataFrame plus column names, selects only the columns it needs (so extra or
clashing columns never matter) and returns a DataFrame keyed by ``doc_id``.
"""
