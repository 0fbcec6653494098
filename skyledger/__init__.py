"""skyledger: a launch-record lakehouse and its analytic marts, on PySpark.

RAW landings (nested JSON) become typed Silver tables, Silver becomes Gold, and
the marts answer analytic questions over Gold and Silver. Every step is a
``DataFrame -> DataFrame`` function; nothing is collected on the way.
"""

__version__ = "0.1.0"
