"""Continuous compliance measurement on Spark.

Raw security records become metric rows, metric rows become a latest-only
detail table and a dated summary table, and the summary becomes weighted
red/amber/green reports.  Every step is a DataFrame-to-DataFrame function.
"""
