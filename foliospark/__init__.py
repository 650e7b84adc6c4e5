"""foliospark: audit, reconciliation and cleaning of tables extracted from paginated documents, on PySpark."""

import sys as _sys

from pyspark.cloudpickle import register_pickle_by_value as _by_value

# Python workers get the functions they run with the plan, so a cluster needs no copy of this package on its nodes.
_by_value(_sys.modules[__name__])
