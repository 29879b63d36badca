"""Column expressions: cleaning, times, numbers and display values."""
