"""A PySpark engine for local-event announcements: sources, normalisation, matching, merging and published views."""
