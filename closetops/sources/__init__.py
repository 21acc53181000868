"""Table access: the calendar dimension and the warehouse bindings."""
