"""End-to-end models over caller-supplied frames."""
