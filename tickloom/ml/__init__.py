"""Direction model over bars."""
