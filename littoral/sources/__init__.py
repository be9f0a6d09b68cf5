"""Sources and sinks: shapefiles, the table of regions, and driver-side upkeep of inputs."""
