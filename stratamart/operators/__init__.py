"""Reusable DataFrame operators: DataFrame in, DataFrame out, no actions."""
