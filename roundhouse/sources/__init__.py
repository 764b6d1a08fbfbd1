"""Reading and writing of annotation files as tables."""
