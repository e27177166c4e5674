"""One-minute bar lake on Spark.

Functions take and return DataFrames; nothing is kept on the driver.

* ``functions`` - column expressions (symbols, times, trading calendar, guards)
* ``sources``   - scans and sinks (payload landing, fragments, daily lake, reports)
* ``operators`` - payload parsing, gap fill, quality screens, profiles, reconciliation
* ``plans``     - whole jobs (daily build, consolidation, purge, reorganisation)
* ``streaming`` - incremental ingest of a landing folder
* ``catalog``   - every query with its SQL twin, on the shared test tables
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
