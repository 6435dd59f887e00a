"""Operators for training-data pipelines: quality rules, filters, tokenising, archives, mixing, search, de-duplication.

Nothing outside this package imports it. ``queries`` registers one query per operator.
"""
