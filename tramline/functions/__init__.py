"""Column functions: clocks and dates, text, nested data, row-wise helpers."""
