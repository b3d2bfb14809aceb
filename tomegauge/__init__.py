"""Readability analytics on Spark DataFrames.

Every public function takes and returns DataFrames (or Columns), so the pieces
chain with ``DataFrame.transform`` and Catalyst sees one plan.
"""
