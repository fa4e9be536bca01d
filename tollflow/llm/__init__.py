"""Operators for preparing training data.

Nothing else in the library imports this subpackage.  The functions that run
in Spark's Python workers are shipped with each job, so the workers need not
have the package on their own path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
