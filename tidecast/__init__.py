"""tidecast: Spark-native time-series forecasting engine.

Operators are plain DataFrame -> DataFrame functions built from Spark's own
expressions (models return fitted MLlib pipelines).  See README.md.
"""

__version__ = "0.1.0"
