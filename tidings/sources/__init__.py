"""Sources: landed feed files and tables projected to the one item schema."""
