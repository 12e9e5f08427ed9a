"""Where results go: appended tables, databases, and batch logs of streaming upserts."""
