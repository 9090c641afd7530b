"""Training-data operators: one module per operator, their queries in `queries`, SQL in `oracle`.

Nothing outside this package imports it. Task functions travel with the jobs that use them, so
executors need the public libraries only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
