"""Labelled-table analytics and feature engineering on Spark DataFrames."""
