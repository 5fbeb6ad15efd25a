"""SQL statements that give the same results over the same sample tables."""
