"""Operators of a training-data pipeline: ten methods over documents and pages.

The functions that run in tasks travel with the job, so that executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
