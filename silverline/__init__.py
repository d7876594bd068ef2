"""silverline: bronze-to-silver medallion operators on PySpark.

Every public function takes and returns Spark DataFrames (or builds them from
a SparkSession). Nothing pulls table data through the driver: plans are
declared with the DataFrame / SQL API and Catalyst + AQE choose the physical
strategy.
"""

from silverline.session import build_session
from silverline.catalog import Tables

__all__ = ["build_session", "Tables"]
