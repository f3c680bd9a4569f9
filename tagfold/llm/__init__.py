"""Operators for preparing training data, written as Spark jobs.

One module per operator. Nothing else in the library imports this package;
the registered queries are in ``queries`` and the chained pipeline in
``corpus_pipeline.py`` at the repository top.
"""
