"""The four end-to-end analyses."""
