"""Evidence analytics on Spark: resolution, claim logs, crowding, moves, digests and back-tests as DataFrame operators."""
