"""Training-data operators (URL rules, BPE, near-duplicate joins, decontamination,
quality, substring and line dedup, secrets, WARC archives, toxicity).

Each module holds one operator with its own interface; ``queries.py`` registers
the thin contract queries and ``oracle.py`` their DuckDB statements.
"""
