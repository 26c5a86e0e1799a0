"""Reading the inputs and writing the report."""
