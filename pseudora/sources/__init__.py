"""Reading landing files and writing or listing catalog tables."""
