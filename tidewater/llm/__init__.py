"""Operators that prepare text corpora for training language models."""

import os
import sys

from pyspark import cloudpickle

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Python workers that can't import the package get its functions with each task.
if _ROOT not in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]:
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
