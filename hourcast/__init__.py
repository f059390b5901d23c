"""hourcast: hourly expected-volume monitoring on Spark."""

import sys as _sys

try:  # Ship our Python functions (bodies of Arrow maps) by value to executors,
    # so Python workers need pyspark and the libraries used but not this package installed.
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: fall back to by-reference
    pass
