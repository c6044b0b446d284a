"""Live reports and controllers on Structured Streaming."""
