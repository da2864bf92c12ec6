"""Plan shapes shared by operators: split ranks, running totals, blocked nearest search."""
