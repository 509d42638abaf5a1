"""Part of corpusloom."""
