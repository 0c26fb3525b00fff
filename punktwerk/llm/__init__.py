"""Operators for building training corpora from the ``documents`` table.

Nothing outside this subpackage imports it; the queries are registered by
``__spark_entry__`` when the subpackage is present.
"""
