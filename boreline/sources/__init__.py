"""Table contracts, reads, writes and the views over the test tables."""
