"""Causal program evaluation on Spark: every operator handles all studies at once."""
