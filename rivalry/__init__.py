"""Contest-history analytics on Spark.

Every operator takes DataFrames (plus column names) and returns a DataFrame.
Sub-packages: ``sources`` (files and models), ``functions`` (scalar column
expressions), ``operators`` (relational work), ``plans`` (the stages of the
contest job) and ``queries`` (what the driver registers).
"""
