"""specflow: requirement texts -> work items -> judged scores, on Spark.

Every operator takes a DataFrame (or a Column) and returns one.  Only the
operators in ``operators.inference`` start Python workers; everything else is
built from native Spark expressions.
"""

import sys

from pyspark import cloudpickle

from specflow.plans.flow import Flow, Step

# executors receive our functions with the task and need no installation
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Flow", "Step"]
