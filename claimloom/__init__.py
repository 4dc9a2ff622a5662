"""Claims warehouse toolkit: CSV deliveries to a star schema, on Spark DataFrames."""
