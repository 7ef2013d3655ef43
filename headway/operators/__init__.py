"""Operators on DataFrames that the models are composed of."""
