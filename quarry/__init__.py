"""Text index, document extraction and mention analytics on Spark."""
