"""PySpark-native operators for a medallion lakehouse.

Sub-packages:

* ``functions``  Column -> Column helpers (casts, masks, PII patterns, similarity)
* ``operators``  DataFrame -> DataFrame operators
* ``sources``    readers, writers, versioned tables, maintenance
* ``streaming``  Structured Streaming pipelines and change-data capture
* ``plans``      models composed from operators
* ``bindings``   the operators bound to the shared test tables, with oracle SQL
"""
