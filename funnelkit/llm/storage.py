"""Tables written to the folder that all executors share, to cut lineage."""

from __future__ import annotations

from ..storage import discard, new_path, shared_folder, written

__all__ = ["discard", "new_path", "shared_folder", "written"]
