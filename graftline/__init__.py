"""graftline: sequence-assembly graph analytics expressed as Spark DataFrames."""
