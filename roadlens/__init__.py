"""roadlens: road-network and driving-recording analytics on Spark DataFrames."""
