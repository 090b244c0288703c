"""Folders for tables that only live as long as a job."""

import uuid


def scratch_root(folder: str, purpose: str) -> str:
    """A new folder under `folder`, which must be in a store that all executors share."""
    if not folder:
        raise ValueError("a shared folder is needed for intermediate tables")
    return f"{folder.rstrip('/')}/strata-{purpose}-{uuid.uuid4().hex}"
