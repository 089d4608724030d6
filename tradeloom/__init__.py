"""tradeloom: a sales warehouse, data mart and data-quality jobs written for Spark."""
