"""Extension: hourly counts of an event stream."""
