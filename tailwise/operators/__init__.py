"""Relational and actuarial operators, DataFrame in and DataFrame out."""
