"""quarry: data-mining operators (profiling, imputation, time-series windows,
outliers, association rules, clustering, classification) expressed as Spark
DataFrame / SQL / ML jobs.

Every operator takes DataFrames and returns a DataFrame; nothing is collected
to the driver except small, bounded statistics (a handful of rows per column).
"""

__version__ = "0.1.0"
