"""Implementation-outcome measures for health-service programmes, on Spark DataFrames."""
