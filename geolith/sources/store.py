"""Files of any store that pyarrow knows, by their path or URI."""

from __future__ import annotations

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; paths without a scheme are mounted ones."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def read_range(path: str, at: int, size: int) -> bytes:
    store, name = located(path)
    with store.open_input_file(name) as f:
        return f.read_at(size, at)


def size_of(path: str) -> int:
    store, name = located(path)
    return store.get_file_info(name).size


def files_below(path: str, ends: tuple[str, ...]) -> list[str]:
    """A file itself, or the files below a folder whose names end so, in order; as URIs if the path is one."""
    store, name = located(path)
    info = store.get_file_info(name)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.is_file:
        return [path]
    below = store.get_file_info(fs.FileSelector(name, recursive=True))
    scheme = path.partition("://")[0] + "://" if "://" in path else ""
    return sorted(scheme + f.path for f in below if f.is_file and f.path.lower().endswith(ends))
