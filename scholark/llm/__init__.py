"""Operators for preparing text corpora at scale.

Nothing outside this subpackage imports it.  Each module holds a kernel (plain Python / numpy, testable without
Spark) and the DataFrame operator built on it; ``queries`` registers the ``pN_`` queries.
"""
