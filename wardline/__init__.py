"""Raw city open data to analysis-ready marts, as Spark jobs."""
