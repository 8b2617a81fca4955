"""Operators for preparing training text. Nothing else in annoforge imports this subpackage."""
