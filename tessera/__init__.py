"""Image and table analytics as plain Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

from tessera.session import get_session

# Workers get the code of this package along with each UDF and need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_session"]
