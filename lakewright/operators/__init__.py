"""Operators: frames and plain arguments in, frames out. None of them starts a job unless it says so."""
