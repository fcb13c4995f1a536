"""daybook: log and trip analytics as Spark DataFrame operators.

Every operator takes a DataFrame and returns a DataFrame built from Spark's
own functions, so Catalyst plans it and the cluster runs it. No operator
calls an action; the caller decides when to collect, show or write.
"""

__version__ = "0.1.0"
