"""News-and-price feature, label and evaluation operators as Spark DataFrame functions."""
