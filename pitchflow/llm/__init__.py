"""Operators for training-data pipelines: one module per operator.

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
adds its queries when it is present.
"""
