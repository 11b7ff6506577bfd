"""Training-data operators: one module per operator, with its query and SQL."""
