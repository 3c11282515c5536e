"""Path functions: directory, base name, extension, and the extension sets of the file operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The extensions each operator works on; ordered ones are priorities.
EXTENSIONS = {
    "language": "mp3 wav flac m4a opus ogg wma aac webm weba", "convert": "mp3 wav flac ogg aac wma m4a opus aiff alac",
    "second_round": "mp3 wav flac m4a opus", "split": "wav mp3 flac m4a ogg aac opus webm weba", "split_legacy": "wav mp3 flac m4a ogg aac opus",
    "digit": "mp3 wav aac flac ogg m4a", "metadata": "mp3 wav", "random_copy": "mp3 wav flac aac ogg wma m4a",
    "length": "mp3 wav flac aac ogg m4a opus", "histogram": "mp3 flac aac ogg m4a wma alac wav", "noise": "wav mp3 flac ogg m4a webm",
    "spectrum": "wav mp3 flac ogg", "triple": "mp3 txt json",
}


def extensions(name: str) -> list[str]:
    return EXTENSIONS[name].split()


def slashes(path: Column) -> Column:
    """Backslashes as slashes."""
    return F.translate(path, "\\", "/")


def directory(path: Column) -> Column:
    """What is before the last slash; empty without one."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def base(path: Column) -> Column:
    """The file name without its extension; leading dots begin no extension."""
    name = file_name(path)
    cut = F.regexp_extract(name, r"^(\.*[^.].*)\.[^.]*$", 1)
    return F.when(cut == "", name).otherwise(cut)


def extension(path: Column) -> Column:
    """The extension in lower case, without its dot; empty without one."""
    return F.lower(F.regexp_extract(file_name(path), r"^\.*[^.].*\.([^.]*)$", 1))


def parts(path: Column) -> list[Column]:
    p = slashes(path)
    return [directory(p).alias("dir"), base(p).alias("base"), extension(p).alias("ext")]


def moved(target: str, path: Column, root: str = "/", keep_tree: bool = True) -> Column:
    """Where a file goes below ``target``: in its own directory, or without it."""
    relative = F.regexp_replace(slashes(path), f"^{root}", "")
    return F.concat_ws("/", F.lit(target), relative if keep_tree else file_name(slashes(path)))
