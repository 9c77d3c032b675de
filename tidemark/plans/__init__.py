"""Business pipelines composed from the operators."""
