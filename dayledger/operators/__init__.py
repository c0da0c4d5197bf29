"""DataFrame operators; every one takes its keys and columns as arguments."""
