"""Operators of a training-data pipeline, each built by one named method.

Functions that run in Python workers are sent by value, so that executors need no copy of the
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
