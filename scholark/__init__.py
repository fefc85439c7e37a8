"""Evidence analytics on scientific literature, written as lazy Spark DataFrame operators."""
