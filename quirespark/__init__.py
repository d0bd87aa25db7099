"""Spark-native analysis of paged documents.

The package is a library of ``DataFrame -> DataFrame`` operators.  Layout,
semantic structuring, translation planning, quality rules and search documents
live in :mod:`quirespark.operators`; the optional subpackage
:mod:`quirespark.llm` holds the operators for training data and is imported by
nothing else here.
"""

__version__ = "0.1.0"
