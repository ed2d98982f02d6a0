"""Operators for preparing large training corpora.

Nothing outside this subpackage imports it. ``millwright.llm.registry`` lists
the queries and the SQL that goes with them.
"""
