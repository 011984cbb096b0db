"""Visual annotation analytics as ordinary Spark queries."""
