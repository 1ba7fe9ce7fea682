"""Set-level operators: DataFrames in, DataFrames out, all athletes at once."""
