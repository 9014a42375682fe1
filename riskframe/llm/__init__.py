"""Training-data operators: thirteen distributed operators and their queries.

Nothing else in the library imports this subpackage.
"""
