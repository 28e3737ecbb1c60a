"""vigil: incident-surveillance analytics as Spark DataFrame operators.

Sub-packages
------------
sources    readers, typed ingest, name cleaning, sinks, literal tables
functions  Column -> Column expressions (strings, rules, times, conditions, ids)
operators  DataFrame -> DataFrame operators (dedup, joins, aggregates, tables,
           collapse, imputation, places, text, geometry)
plans      composed builds and report sets, plus the registered query catalog
streaming  incremental application of the row-level builds to a stream
"""

__version__ = "0.1.0"
