"""Training-data pipeline operators: one module per operator, queries in ``queries``."""
