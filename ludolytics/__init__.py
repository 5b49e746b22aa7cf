"""Review analytics, features, recommendation and retrieval as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# tasks carry the package's few Python functions with them, so executors need no
# copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
