"""Case records as Spark DataFrames: pages in, one row per attorney out."""
