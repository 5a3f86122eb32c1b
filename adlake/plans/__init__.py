"""Report models: specifications and the frames they produce."""
