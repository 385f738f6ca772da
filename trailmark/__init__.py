"""trailmark: product analytics as Spark plans.

Operators take and return lazy DataFrames over eight telemetry tables (users, subscriptions,
events, experiments, assignments, metrics, feature usage, support tickets).
"""

import sys

from pyspark import cloudpickle

# The few Python functions that run inside tasks travel with the plan, so executors need numpy, pandas
# and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
