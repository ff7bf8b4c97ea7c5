"""Map-data analytics as Spark jobs: functions from DataFrames to DataFrames."""
