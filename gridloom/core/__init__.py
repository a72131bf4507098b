"""Session set-up and the distributed building blocks the operators share."""
