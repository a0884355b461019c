"""Reading, checking and writing the six tables, the results and the models."""
