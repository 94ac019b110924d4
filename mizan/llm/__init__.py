"""Operators for preparing training text at scale.

Nothing outside this subpackage imports it.  Every module holds a kernel (plain
Python or numpy, no Spark), an operator over DataFrames with a general
interface, and a thin ``opN_*`` query that binds it to one table.
"""
