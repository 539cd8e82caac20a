"""DataFrame operators over per-item timelines: spine, intervals, islands, sequences, ranking."""
