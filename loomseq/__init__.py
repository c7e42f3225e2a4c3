"""Single-cell long-read sequencing data as Spark DataFrames."""
