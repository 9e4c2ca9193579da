"""Operators on training data: each solves one problem of the list by the method named there."""
