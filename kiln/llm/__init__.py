"""Operators of a training-data pipeline: dedup, search, filters, mixing, packing, chat."""
