"""Request planning, processing recipes and whole loads."""
