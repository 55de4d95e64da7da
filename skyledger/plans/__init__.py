"""The domain's jobs, put together from the operators."""
