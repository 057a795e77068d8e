"""Point-in-time limit-up ranking jobs and training-data operators on Spark DataFrames."""
