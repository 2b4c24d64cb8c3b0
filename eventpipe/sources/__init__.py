"""Where records, files and remote images come from, and where records are sent."""
