"""Operators for preparing training text at scale.

Nothing outside this folder (and ``corpus_pipeline.py``, ``tests/llm``)
imports it; ``queries.py`` holds the registered queries and their SQL.
"""
