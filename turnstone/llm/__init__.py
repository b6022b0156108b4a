"""Operators for preparing language-model training data, one module per operator.

Nothing else in the library imports this package; ``queries.py`` registers its
queries and ``__spark_entry__.py`` adds them when the package is present.
"""
