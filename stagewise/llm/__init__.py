"""Operators for preparing language-model training text, as Spark jobs.

One module per operator; ``queries`` registers them on the driver tables.
Nothing outside this subpackage imports it.
"""
