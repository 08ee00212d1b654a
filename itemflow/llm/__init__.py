"""Operators for preparing training text at scale; each module has one of them and its own interface.

Executors need no copy of the package: what tasks run is sent to them whole.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
