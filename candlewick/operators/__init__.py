"""DataFrame -> DataFrame operators; batch or streaming where meaningful."""
