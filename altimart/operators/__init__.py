"""DataFrame operators that are not tied to the airline model."""
