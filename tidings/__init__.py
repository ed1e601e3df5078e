"""tidings: a Spark-native news-recommendation engine.

Families: article ingest and temporal routing (``operators.ingest``), rating
messages (``functions.messages``), alternating ridge regression
(``operators.als``), scoring and top-N (``operators.topn``), streaming list
maintenance (``streaming.ratings``) and listing / lookup / change / graph views
(``operators.views``, ``operators.changes``).
"""

__version__ = "0.1.0"

# Ship this package's functions by value with each task, so Python workers do not need
# the package on their path (clusters can still use --py-files; this keeps a bare
# spark-submit of a script that imports tidings working).
import sys as _sys

try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the API
    pass
