"""Relational operators over text records: DataFrame in, DataFrame out."""
