"""Build and evaluate conversational example sets with Spark."""
