"""candela: trade analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, so Catalyst plans it (pushdown, pruning, partial aggregation,
whole-stage codegen) and the same function serves batch tables and, where the
operator is stateless or a windowed aggregate, Structured Streaming sources.
"""

from candela.session import get_spark, checkpoint_root  # noqa: F401

__all__ = ["get_spark", "checkpoint_root"]
