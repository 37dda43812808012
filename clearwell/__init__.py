"""Cleaning and analysis of multi-source commerce data on Spark."""
