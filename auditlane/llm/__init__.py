"""Training-data operators: one module per operator, `queries` registers them.

Nothing outside this subpackage imports it; it may use general helpers of the library.
"""

import sys

from pyspark import cloudpickle

# What runs inside tasks travels with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
