"""Operations of a training-data pipeline over text tables.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; the thin ``opN_*`` queries are in ``queries``.
"""
