"""Classification and word statistics for short texts, as Spark DataFrame jobs."""
