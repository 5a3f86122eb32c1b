"""DataFrame operators: each takes frames and gives back a lazy frame."""
