"""Comment-thread analytics as Spark jobs: cleaning, sentiment, reply networks, terms and model comparison."""
