"""The daily load, driven by new landing files."""
