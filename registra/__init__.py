"""Learning-log marts, skills inference and bank data work on Spark DataFrames."""
