"""Operators for preparing training text: one module per operator, each usable on its own."""
