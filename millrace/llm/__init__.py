"""Operators for preparing training data, and the queries that bind them to the tables.

Nothing else in the package imports this folder; ``__spark_entry__.py`` adds the
queries of ``millrace.llm.catalog`` when the folder is there.
"""
