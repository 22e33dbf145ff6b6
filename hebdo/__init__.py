"""hebdo: a weekly health-and-environment feature engine on Spark.

Everything is a plain ``DataFrame -> DataFrame`` or ``Column -> Column`` function built from
Spark's built-in expressions, so Catalyst sees the whole plan (pruning, pushdown, codegen).
"""

__version__ = "0.1.0"
