"""Column functions: times, units and the texts of messages and files."""
