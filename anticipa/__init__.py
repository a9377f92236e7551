"""Invoice-financing analytics as lazy Spark plans."""
