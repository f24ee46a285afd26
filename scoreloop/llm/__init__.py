"""Operators for large training-data pipelines (see README, section llm).

Each module holds one operator with a general interface; ``queries`` holds
the thin registered queries. Nothing outside this package imports it.
"""
