"""Reading, normalising and combining campaign facts."""
