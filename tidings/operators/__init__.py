"""DataFrame operators. Each takes DataFrames and returns DataFrames; nothing is collected to the driver."""
