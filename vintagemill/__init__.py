"""Probability-of-default analytics on loan-level data, written for Spark.

Every operator takes DataFrames and returns a lazy DataFrame.  The few places
that have to run a job while a plan is being built (bucket edges, quantile
thresholds, encoder tables, the two Platt coefficients) keep only bounded
results on the driver, or a table in the shared checkpoint folder.
"""
