"""Writers, publishing, compaction and catalog jobs."""
