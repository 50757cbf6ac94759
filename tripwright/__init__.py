"""Trip-record analytics on Spark: validate, profile, fit, evaluate and score ride tables."""
