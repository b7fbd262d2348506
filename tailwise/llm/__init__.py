"""Operators on large text collections: mixing, tokens, near and exact copies, scores, filters.

Nothing else in the package imports this folder. Every operator reads the columns it names and
ignores all others, so further columns, whatever their names, neither clash nor come back.
"""
