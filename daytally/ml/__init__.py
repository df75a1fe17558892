"""Features, regression models and clusters on Spark ML."""
