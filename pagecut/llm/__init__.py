"""Training-data pipeline operators: one module for each operator, thin queries in ``queries``."""
