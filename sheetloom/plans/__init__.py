"""Sheet builders: DataFrames in, one DataFrame per sheet out, nothing executed."""
