"""Daily demand forecasts per customer, warehouse and SKU, as Spark DataFrame operators and jobs."""

import sys

from pyspark import cloudpickle

PAIR = ["customer_code", "warehousecode"]
SERIES = [*PAIR, "Shop_SKU"]

# the few Python functions travel with their tasks, so executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
