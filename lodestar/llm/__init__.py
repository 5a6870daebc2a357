"""Training-data operators: tokenising, packing, de-duplication, scoring, search.

Nothing outside this subpackage imports it; ``queries.py`` registers one query
per operator.
"""
