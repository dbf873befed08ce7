"""Layered commerce warehouse built on Spark DataFrames.

Layers: source facts -> daily increments (ODS) -> dimensions and detail
snapshots (DIM, DWD) -> period aggregates (DWS) -> result sets (ADS) ->
published result tables, plus the order event contract and its stream.
"""
