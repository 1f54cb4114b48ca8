"""tessera: distributed tabular modelling on Spark DataFrames.

Rows always stay in Spark.  Only per-feature summaries, small triangular
factors (R of a QR decomposition), coefficients and cluster centres reach the
driver; every fitted step is a frozen set of parameters that turns into plain
Column expressions, so it applies to batch and streaming DataFrames alike.
"""

import sys

from pyspark import cloudpickle as _cloudpickle

from tessera.session import ensure_checkpoint_dir, local_session, materialize

# Functions of this package that run inside tasks (mapInPandas /
# applyInPandas bodies) are shipped by value, so executors need no install.
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["local_session", "ensure_checkpoint_dir", "materialize"]
