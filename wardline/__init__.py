"""Bulk evaluation of data-access rules on Spark.

Logs of SQL statements and the relations they touch go in; access requests, decisions,
denial messages, visible-table lists and audit rows come out, as DataFrames.
"""
