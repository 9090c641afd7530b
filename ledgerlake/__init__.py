"""ledgerlake: loan and payment data, cleaned, kept and reported with Spark DataFrames."""

__version__ = "0.1.0"
