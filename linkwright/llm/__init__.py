"""Operators for preparing training text. Nothing else in linkwright imports this subpackage."""
