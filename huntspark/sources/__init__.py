"""Reading tables with the searches analysts know, and writing results."""
