"""Operators for preparing training text and vectors at scale, and their registered queries.

Nothing outside this package imports it. Operators live in their own modules with general parameters;
``catalog`` holds the thin ``opN_<name>`` queries and their SQL texts.
"""
