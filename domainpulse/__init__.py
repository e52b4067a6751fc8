"""domainpulse: data-health analytics for business data domains on Spark.

Raw tables are profiled into daily quality metrics, checked, rolled up over
a trailing window, clustered and scored.  Every operator is a lazy
``DataFrame -> DataFrame`` function; nothing runs until a sink or action.
"""

__version__ = "0.1.0"
