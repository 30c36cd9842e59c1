"""Whole analyses composed from the operators, on the hospital table layout."""
