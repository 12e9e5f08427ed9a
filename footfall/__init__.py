"""Footfall: user-behaviour analytics for e-commerce, written on Spark DataFrames."""
