"""Jobs: operators chained from landed files to signals."""
