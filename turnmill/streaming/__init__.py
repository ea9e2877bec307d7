"""The narrow operators over streams of files."""
