"""tapesh: event analytics over day-partitioned message streams, on Spark DataFrames."""
