"""Audience and ad-analytics jobs on Spark DataFrames."""
