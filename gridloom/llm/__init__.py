"""Operators for training-data pipelines, with their registered queries.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries if it is there.
"""
