"""Procurement and commerce analytics as a library of PySpark jobs.

Every job is a plain function from DataFrames to a DataFrame.  Nothing in a job triggers an
action; the caller decides when and where the plan runs.
"""
