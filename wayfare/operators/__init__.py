"""Relational operators of the booking model (DataFrame in, DataFrame out)."""
