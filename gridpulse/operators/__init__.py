"""Operators: each is ``DataFrame(s) + column names + parameters -> DataFrame``."""
