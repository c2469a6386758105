"""DataFrame operators.  Each takes and returns DataFrames; nothing is collected."""
