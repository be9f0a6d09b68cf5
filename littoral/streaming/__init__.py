"""Nothing here yet: every operator that is covered is a batch one; inputs are refreshed by plan, not by stream."""
