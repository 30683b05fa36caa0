"""Sources: file drops, the message broker, table tails."""
