"""Change-event lakehouse operators for PySpark: every operator is DataFrame -> DataFrame."""

import sys

from pyspark import cloudpickle

# The few Python functions that run inside tasks travel with their code, so executors need no
# installed copy of this package and the driver may start in any folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
