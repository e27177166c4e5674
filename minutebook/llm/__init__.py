"""Operators for preparing training text at scale; nothing else in the library imports this subpackage.

One module per operator, each with its own general interface; ``queries`` applies them to the shared tables.
"""
