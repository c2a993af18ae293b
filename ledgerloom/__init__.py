"""ledgerloom: deterministic financial-statement analytics expressed as Spark DataFrames."""
