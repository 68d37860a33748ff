"""bourse: a PySpark feature engine for market time series.

Daily bars, statements, corporate actions and macro / index series go in as
long keyed DataFrames; monthly per-ticker feature tables, labels, splits and
model reports come out.  Every operator is a DataFrame function.
"""

__version__ = "0.1.0"
