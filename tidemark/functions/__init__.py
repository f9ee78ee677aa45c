"""Column-expression helpers (``pyspark.sql.functions`` only, no UDFs)."""

from tidemark.functions.columns import *  # noqa: F401,F403
