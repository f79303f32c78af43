"""Card catalogue and price history jobs, and corpus preparation, on Spark."""
