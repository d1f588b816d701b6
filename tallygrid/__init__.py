"""tallygrid: table-in / table-out analytics operators on Spark DataFrames."""
