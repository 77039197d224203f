"""Sinks: versioned monthly snapshot tables with a run ledger."""

from .bucketed import BucketedTable
from .snapshot import (Commit, Run, SnapshotTable, StagedRun, checkpoint_dir, literal_rows, matching_paths,
                       new_attempt, new_run_id, path_matches, remove_dir, shared_dir)

__all__ = ["BucketedTable", "Commit", "Run", "SnapshotTable", "StagedRun", "checkpoint_dir", "literal_rows", "matching_paths",
           "new_attempt", "new_run_id", "path_matches", "remove_dir", "shared_dir"]
