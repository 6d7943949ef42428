"""larder: retail price intelligence as Spark DataFrame plans.

Every public function takes and returns DataFrames; only fixed-size
statistics (model metrics, small regression Gram matrices) ever reach the
driver.
"""

__version__ = "0.1.0"
