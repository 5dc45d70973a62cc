"""Record linkage and training-data operations on Spark DataFrames."""
