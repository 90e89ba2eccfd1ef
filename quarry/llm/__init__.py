"""Operators for large-scale training-data pipelines.  Nothing else in the library imports
this subpackage; queries and oracle SQL are in :mod:`quarry.llm.catalog`."""
