"""Operators for preparing training data. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Tasks get the functions of these modules themselves, so the package need not be installed on every machine.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
