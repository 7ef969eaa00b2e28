"""DataFrame -> DataFrame operations on panels and dimensions."""
