"""Training-data operators: extraction, dedup, filtering, tokenising, packing.

Nothing outside this folder imports it; ``queries`` lists the registered
``opN_<name>`` queries.  Every operator names its columns as parameters, takes
a DataFrame and returns a DataFrame.

Functions of this package that run in tasks travel by value, so executors need
no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
