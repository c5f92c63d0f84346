"""lexmill: Spark jobs for building, cleaning, linking and checking a corpus of court decisions."""
