"""The folder that all executors share, and tables written there to cut lineage."""

from ..sources.shared import discard, new_path, shared_dir, stage

__all__ = ["discard", "new_path", "shared_dir", "stage"]
