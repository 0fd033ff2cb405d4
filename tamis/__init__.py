"""Text-corpus preparation on Spark DataFrames: clean, deduplicate, tokenize, analyse, format."""
