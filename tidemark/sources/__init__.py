"""Reading and writing tables, event logs and increments."""
