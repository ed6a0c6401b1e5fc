"""Folders that driver and executors share, read file by file."""

from __future__ import annotations

import re
from pathlib import Path
from urllib.parse import unquote

#: Characters that Spark writes as %XX in the folder names of partitions.
_ESCAPED = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")


def shared_path(path: str) -> Path:
    """A path without its scheme; only a file system that all nodes mount can be read so."""
    return Path(path.removeprefix("file://").removeprefix("file:"))


def partition_folder(column: str, value: str) -> str:
    """The name of the folder that holds a partition's files."""
    return f"{column}=" + _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value)


def partition_value(folder: Path) -> str:
    """The way back from a partition's folder."""
    return unquote(folder.name.partition("=")[2])


def whole_text(folder: Path) -> str | None:
    """The text of a folder's part files in order; None without any."""
    parts = sorted(folder.glob("part-*"))
    return "".join(p.read_text(encoding="utf-8") for p in parts) if parts else None
