"""Incident and rainfall analytics as plain Spark DataFrame functions.

Every operator takes DataFrames and returns a DataFrame; only sinks and the
file probes run a job.
"""
