"""Plain files in the folder that driver and executors share, from inside tasks."""

from __future__ import annotations

from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named by URI or by a local path."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_file(uri: str, name: str, data: bytes) -> str:
    """Write ``name`` under the folder ``uri``; returns its full path there."""
    system, root = open_folder(uri)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/{name}", compression=None) as out:
        out.write(data)
    return name


class Ranges:
    """Reads byte ranges of files under one folder and keeps the last file open."""

    def __init__(self, uri: str) -> None:
        self.system, self.root = open_folder(uri)
        self.name, self.file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            self.close()
            self.file, self.name = self.system.open_input_file(f"{self.root}/{name}"), name
        self.file.seek(offset)
        return self.file.read(length)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = self.name = None
