"""Complete queries: the questions over the race history, and the live measures in batch form."""
