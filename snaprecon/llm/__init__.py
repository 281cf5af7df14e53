"""Operators for training-data pipelines.

Nothing outside this folder imports it; ``__spark_entry__.py`` registers the
queries of :mod:`snaprecon.llm.catalog` when the folder is present.
"""
