"""Training-data operators: filters, deduplication, decontamination, mixing and sharding of text tables.

Nothing outside this subpackage imports it. Every operator takes and returns DataFrames; the thin
``opN_*`` queries in :mod:`tidings.llm.queries` derive the fixed result columns from them.
"""
