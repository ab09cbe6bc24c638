"""txnscope — transaction-risk analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns DataFrames.  Fitted operators
return their parameters as DataFrames (or small scalar records) and apply
them with plain joins / column expressions, so the same code serves batch
and streaming inputs.
"""

from txnscope.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
