"""predlake: log inference traffic of production ML models into typed tables on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, so one pipeline runs both as a batch job and as a Structured
Streaming query.
"""

__version__ = "0.1.0"
