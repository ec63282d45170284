"""pagecut: page-boundary analytics on Spark.

Bundles (long files made of many shorter documents) become numbered page
tables; pages get labels and feature arrays; Spark ML learns which pages
start a new document; bundles are cut into segments at those pages; and the
quality of the cut is reported.  Every public function takes and returns
DataFrames and is built from Spark expressions, so the same code runs on a
laptop and on a cluster.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Ship this package's functions by value with every Python task, so executors
# need no copy of the package on their path (UDFs never import it at run time).
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from pagecut.session import get_spark, scratch_path  # noqa: E402

__all__ = ["get_spark", "scratch_path"]
