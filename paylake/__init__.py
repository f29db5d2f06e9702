"""A batch lakehouse for payment journeys, written as PySpark DataFrame jobs.

Layers: ``sources`` read daily files and stored tables, ``plans`` turn bronze
rows into silver snapshots, a gold star schema and analyst views, ``sinks``
write tables so that every load can be repeated.  ``functions`` holds the
column expressions, ``operators`` the reusable joins, aggregates, quality and
privacy steps.
"""
