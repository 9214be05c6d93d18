"""Files in the shared folder, opened from tasks by their address."""

from __future__ import annotations

from pyarrow import fs


def opened(address: str) -> tuple[fs.FileSystem, str]:
    """File system and path of an address such as file:///data or hdfs://host/data; a bare path is local."""
    return fs.FileSystem.from_uri(address)
