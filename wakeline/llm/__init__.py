"""Operators for building training corpora (deduplication, filtering, scoring, tokenization, sharding).

Nothing outside this package imports it; :mod:`wakeline.llm.queries` registers its queries.
"""
