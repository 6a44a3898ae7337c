"""Structured Streaming serving: the batch operators applied to a stream of new
records (stateless stream-static joins) and incremental vocabulary counts."""
