"""Written tables, reports and published names."""
