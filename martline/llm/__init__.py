"""Operators of a training-data pipeline, one module each; ``queries`` holds
their registered queries. Nothing outside this folder imports it except the
guarded lookup in ``__spark_entry__.py``."""
