"""Training-data operators: thirteen corpus operators, each in a module of its own.

``registry.QUERIES`` and ``registry.ORACLE_SQL`` hold the driver queries.
Nothing outside this package imports it except the guarded import in
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
