"""Training-data operators: tokenizing, PII, dedup, WARC, URL and quality filters, secrets, fingerprints, packing, search.

Each operator takes the names of the columns it reads and ignores every other
column, so extra columns (also ones that share a name with its output) do no
harm. Nothing outside this package imports it.
"""
