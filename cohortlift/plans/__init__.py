"""Whole evaluation runs composed from the operators."""
