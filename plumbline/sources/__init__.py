"""Reading tables, writing results, and recording what was read."""
