"""gridloom: asset-data analytics on Spark DataFrames."""
