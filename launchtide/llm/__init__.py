"""Operations of a training-data pipeline, each a function of DataFrames.

Nothing else in the library imports this subpackage. Its functions travel to executors
by value, so that a cluster needs Python, numpy and pyarrow but no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
