"""Daily-observation lake built from Spark DataFrame expressions.

Observations (one reading per location and day) move through typed bronze,
feature-enriched silver and aggregated gold tables to serving tables.  Every
operator takes and returns DataFrames; only ``sinks``, ``plans`` and
``streaming`` have side effects.
"""

__version__ = "0.1.0"
