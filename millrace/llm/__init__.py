"""Operators that prepare training data: tokens, deduplication, mixing, packing, scoring and licences.

Nothing else in the library imports this package; `millrace.llm.queries` registers one query per operator.
"""
