"""Labelled-text classification on Spark DataFrames."""
