"""DataFrame-to-DataFrame operators, usable through ``df.transform``."""
