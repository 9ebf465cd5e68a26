"""Training-data operators: each module is one operator, ``queries`` registers them.

Nothing outside this folder imports it (except the guard in ``__spark_entry__.py``
and ``corpus_pipeline.py``), so it can be deleted without touching the rest.
"""
