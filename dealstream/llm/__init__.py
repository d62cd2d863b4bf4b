"""Operators of a training-data pipeline, each by one stated method.

Nothing outside this subpackage imports it; ``queries.py`` registers one query
per operator and ``__spark_entry__.py`` adds them when the folder is present.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Task functions travel with the job, so executors need no copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
