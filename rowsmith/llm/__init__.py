"""Operators for building text corpora: near copies, secrets, token counts, benchmark leaks,
byte pair encoding, token files, quality rules, data selection, licences and languages.

Nothing outside this package imports it. ``queries`` registers one query per operator.
"""
