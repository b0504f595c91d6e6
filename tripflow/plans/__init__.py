"""End-to-end runs made of the operators, one per platform job."""
