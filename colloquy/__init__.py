"""colloquy: dialogue-risk analytics expressed as Spark DataFrame plans.

Every operator is a function DataFrame -> DataFrame (or a small factory for
MLlib stages / streaming queries).  Nothing here collects data to the driver
except bounded model metadata (vocabulary, importances).
"""

import sys as _sys

__version__ = "0.1.0"

# The one Python task function (the similarity block scorer) must run on
# executors that may not have this package installed: ship the package's
# functions by value inside the task instead of by module reference.
try:  # pragma: no cover - depends on the pyspark build
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
