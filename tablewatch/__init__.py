"""tablewatch: table assurance operators expressed as Spark DataFrame plans.

Every public operator is a function ``(DataFrame..., params, as_of) -> DataFrame``.
Nothing is collected to the driver except one-row threshold or cursor values.
"""

from tablewatch.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
