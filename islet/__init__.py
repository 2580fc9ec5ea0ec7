"""Cohort statistics over entities, loci and groups, as Spark jobs."""
