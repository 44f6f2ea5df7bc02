"""The analytic jobs.  Each is a function of DataFrames and parameters that returns a DataFrame."""
