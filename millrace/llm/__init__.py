"""Operators of a training-data pipeline: each is a DataFrame function, bound to the supplied tables in ``queries``."""
