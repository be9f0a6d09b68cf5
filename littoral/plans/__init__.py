"""Plans over several operators: the fold over regions and the refresh plan."""
