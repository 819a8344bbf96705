"""Operators for preparing training text at scale, one module each.

Nothing else in the library imports this subpackage.
"""
