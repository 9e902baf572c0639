"""Sequencing-read analytics and corpus preparation as Spark jobs."""
