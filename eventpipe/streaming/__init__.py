"""Tables that micro-batches write, and the streaming queries that write them."""
