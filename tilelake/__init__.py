"""tilelake: DataFrame operators for tiled geodata catalogs, rasters and transfer logs."""

import sys

from pyspark import cloudpickle

from tilelake.session import build_session

# Task code travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session"]
