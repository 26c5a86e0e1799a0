"""The operators put together: the context report and the batch job."""
