"""DataFrame operators of the hourly monitoring model."""
