"""Spark operators for curating and publishing tables of atomistic datasets.

Every operator takes and returns DataFrames (or Columns) and leaves the
physical plan to Catalyst and adaptive execution.
"""

__version__ = "0.1.0"
