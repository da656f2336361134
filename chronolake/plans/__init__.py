"""Business marts over current rows."""
