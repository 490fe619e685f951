"""First-line probe of landed files, run inside Spark tasks (``mapInPandas``).

This module is shipped *by value* with the task (cloudpickle), so executors
need no installed copy of the package to run it.
"""

from __future__ import annotations

# Bytes read at once when looking for the first line break; a header may be of any length.
PROBE_BYTES = 1 << 16


def _open_input(path: str):
    """Open ``path`` for reading with pyarrow's filesystems (None when unsupported)."""
    from urllib.parse import unquote, urlparse

    import pyarrow.fs as pafs

    if path.startswith("file:"):
        local = unquote(urlparse(path).path) if "%" in path else path[len("file:"):]
        while local.startswith("//"):
            local = local[1:]
        return pafs.LocalFileSystem().open_input_stream(local)
    uri = "s3://" + path[len("s3a://"):] if path.startswith("s3a://") else path
    fs, rel = pafs.FileSystem.from_uri(uri)
    return fs.open_input_stream(rel)


def _first_line(path: str) -> tuple[str | None, bool]:
    """First line of a file (``None`` for a zero-byte file); ``False`` if it cannot be opened."""
    try:
        with _open_input(path) as f:
            buf = b""
            while True:
                chunk = f.read(PROBE_BYTES)
                if not chunk:
                    break
                buf += chunk
                if b"\n" in chunk or b"\r" in chunk:
                    break
    except Exception:  # unsupported scheme, permissions, ...
        return None, False
    if not buf:
        return None, True
    if buf.startswith(b"\xef\xbb\xbf"):  # UTF-8 byte-order mark: Spark's readers drop it too
        buf = buf[3:]
    line = buf.replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n", 1)[0]
    return line.decode("utf-8", errors="replace"), True


def first_lines(batches):
    """``mapInPandas`` body: read the first line of each file, a few files at a time in parallel."""
    from concurrent.futures import ThreadPoolExecutor

    import pandas as pd

    with ThreadPoolExecutor(max_workers=16) as pool:
        for pdf in batches:
            res = list(pool.map(_first_line, pdf["path"].tolist()))
            yield pd.DataFrame(
                {"path": pdf["path"], "header": [h for h, _ in res], "read_ok": [ok for _, ok in res]}
            )




def _stat(path: str) -> tuple[int | None, int | None]:
    """(size in bytes, modification time in epoch ms) of a file; (None, None) if unknown."""
    from urllib.parse import unquote, urlparse

    import pyarrow.fs as pafs

    try:
        if path.startswith("file:"):
            local = unquote(urlparse(path).path) if "%" in path else path[len("file:"):]
            while local.startswith("//"):
                local = local[1:]
            fs, rel = pafs.LocalFileSystem(), local
        else:
            uri = "s3://" + path[len("s3a://"):] if path.startswith("s3a://") else path
            fs, rel = pafs.FileSystem.from_uri(uri)
        info = fs.get_file_info(rel)
    except Exception:  # unsupported scheme, permissions, ...
        return None, None
    if info.type != pafs.FileType.File:
        return None, None
    mtime = info.mtime_ns // 1_000_000 if info.mtime_ns is not None else None
    return info.size, mtime


def file_stats(batches):
    """``mapInPandas`` body: size and modification time of each file (metadata only)."""
    from concurrent.futures import ThreadPoolExecutor

    import pandas as pd

    with ThreadPoolExecutor(max_workers=16) as pool:
        for pdf in batches:
            res = list(pool.map(_stat, pdf["path"].tolist()))
            yield pdf.assign(
                file_size=pd.array([r[0] for r in res], dtype="Int64"),
                file_modified_ms=pd.array([r[1] for r in res], dtype="Int64"),
            )


def file_stats_task():
    """``file_stats``, registered so its code travels with the task."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return file_stats


def first_lines_task():
    """``first_lines``, registered so its code travels with the task."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return first_lines
