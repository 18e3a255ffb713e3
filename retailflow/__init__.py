"""retailflow: table-to-table retail operations jobs on Spark DataFrames."""
