"""Time-stamped patient cohorts and outcome labels on Spark DataFrames."""
