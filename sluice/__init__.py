"""sluice: a Spark-native load, sync and report engine.

Every operation is a DataFrame-in / DataFrame-out function (or a distributed
write returning a status frame) built from Spark's own expressions.
"""

__version__ = "0.1.0"
