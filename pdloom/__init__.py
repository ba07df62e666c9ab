"""Loan-default (probability of default) analytics on Spark DataFrames."""
