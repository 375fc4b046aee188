"""Operators for preparing training text, one module each.

Nothing else in the library imports this package; it may be deleted with
``tests/llm`` and ``corpus_pipeline.py``.  Registered queries are in
:mod:`tillroll.llm.queries`.
"""
