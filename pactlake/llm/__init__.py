"""Operators for preparing training text: filtering, de-duplication, mixing, formatting and output."""
