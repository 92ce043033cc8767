"""Streaming user statistics on Spark.

Sub-packages:

* ``functions``  column expressions: message parsing, pick rules, JSON encoding
* ``operators``  DataFrame -> DataFrame steps, the same on batch and on streams
* ``sources``    topics, JSON tables, stored state
* ``streaming``  processing-time windows, jobs and sinks
* ``plans``      the registered queries over the test tables
"""
