"""Operators of a training-data pipeline.  Nothing else in the library imports this package.

Functions that run inside Python workers are pickled by value, so executors need neither this
package on their path nor a shared source folder.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
