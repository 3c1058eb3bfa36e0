"""Compositions of the operators: label sets, feature tables, preparation,
model training and the feature report."""
