"""Energy-market analytics on Spark: DataFrame operators, sources, streaming twins and job plans."""
