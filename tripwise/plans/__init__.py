"""Table-level plans: processed zone, analysis marts, run modes."""
