"""forgelake: set-based Spark jobs over software-forge activity data."""
