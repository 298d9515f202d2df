"""Layout-aware document quality analytics as lazy Spark plans."""
