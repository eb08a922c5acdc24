"""Operators for preparing language-model training data, one module each.

Nothing outside this subpackage imports it; ``queries.py`` and ``sql.py`` hold
its driver queries and their SQL.
"""
