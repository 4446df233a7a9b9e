"""Operators for preparing training text.

Nothing outside this folder imports it; each operator is a module of its own and
``entries`` lists the registered queries.
"""
