"""Training-data operators: tokens, text extraction, deduplication, filters, archives.

Nothing outside this package imports it. Its queries are in ``queries``.
"""
