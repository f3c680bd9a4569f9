"""tagfold: user-interest portraits and content analytics on Spark DataFrames.

Sub-packages:
  sources    readers for logs, delimited text and the test tables
  functions  column expressions (tag extraction, decay factor, JSON packing)
  operators  DataFrame -> DataFrame operators (filters, statistics, portraits,
             text features, similarity, recommendation)
  sinks      writers (parquet/CSV publication, table location switch, cells)
  plans      fixtures over the test tables and the registered queries
"""

__version__ = "0.1.0"
