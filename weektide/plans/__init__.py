"""Named end-to-end queries, each with the SQL it is checked against."""
