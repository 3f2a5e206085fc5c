"""Training-data operators: one module per operator, queries in ``queries``.

Nothing outside this subpackage imports it; the driver entry adds its
queries only when it can be imported.

Functions that run inside tasks are shipped by value, so executors need
numpy and pandas but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
