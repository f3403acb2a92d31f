"""Relational and temporal operators: DataFrame in, DataFrame out."""
