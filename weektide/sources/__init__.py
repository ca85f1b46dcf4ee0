"""Reading and writing tables, files and fitted models."""
