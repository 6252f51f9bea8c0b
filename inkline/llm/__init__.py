"""Operators of a training-data pipeline: one module per operator, plus the
driver queries (``queries.py``).  Nothing outside this subpackage (and
``corpus_pipeline.py``) imports it.

Executors import this package by name, so it must be on their path
(``--py-files`` or an installed package), like any PySpark library.
"""
