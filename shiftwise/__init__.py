"""shiftwise: retail demand forecasting and labor planning as Spark DataFrame jobs.

Subpackages: ``sources`` (inputs, files, catalog), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame stages), ``plans`` (wiring,
query registry, reference SQL, export), ``streaming`` (none: batch only).
"""

__version__ = "0.1.0"
