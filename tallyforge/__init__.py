"""tallyforge: receipt quality and analytics as Spark DataFrame jobs."""
