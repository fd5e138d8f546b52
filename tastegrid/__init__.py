"""Recommendation analytics on PySpark DataFrames.

Sub-packages: ``sources`` (readers, writers, domain views), ``functions``
(column expressions), ``operators`` (DataFrame -> DataFrame), ``plans``
(registered queries with their SQL twins) and ``streaming``.
"""

__version__ = "0.1.0"
