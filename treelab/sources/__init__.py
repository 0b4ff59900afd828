"""Reading feature tables, small generated tables, and report sinks."""
