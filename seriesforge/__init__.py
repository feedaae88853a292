"""seriesforge: panel daily time-series preparation, profiling, training and
forecasting on Spark DataFrames.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects and
builds a lazy plan; nothing is collected to the driver except bounded,
per-horizon or per-series metadata (model coefficients, registry rows).
"""

from seriesforge.spec import SeriesSpec

__all__ = ["SeriesSpec"]
__version__ = "0.1.0"
