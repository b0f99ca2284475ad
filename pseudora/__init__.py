"""Customer data mapping, pseudonymization and compliance controls on Spark DataFrames."""
