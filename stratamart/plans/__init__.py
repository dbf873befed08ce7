"""Layer plans: pure functions from input DataFrames to one dataset each."""
