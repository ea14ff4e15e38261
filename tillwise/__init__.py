"""tillwise: retail, clickstream, customer and employee batch jobs on Spark DataFrames."""
