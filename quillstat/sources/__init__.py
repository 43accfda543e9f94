"""Reading and writing feature tables, name lists, summaries and models."""
