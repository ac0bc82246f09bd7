"""Model training, validation and comparison on Spark ML. Training data stays on the executors."""
