"""Row-level and table-level operators."""
