"""skyfold: surveillance-stream analytics and corpus preparation on PySpark."""
