"""A linked-data catalog on Spark: describe files and URLs, build and publish
JSON-LD documents, resolve versions, and query the resulting graph.

Every operator takes DataFrames (or Columns) and returns DataFrames (or Columns).
"""
