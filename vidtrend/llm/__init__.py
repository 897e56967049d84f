"""Operators for preparing training data at scale.

Operators, one module each, and the thin queries over the driver's tables
(``queries.py``).  Nothing else in the library imports this subpackage.
"""
