"""Table-to-table operators: dimensions, conforming, contracts, quality, reads and changes."""
