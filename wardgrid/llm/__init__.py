"""Operators for large-scale training-data pipelines.  Nothing else in the library imports this package."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions that run inside Spark tasks travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
