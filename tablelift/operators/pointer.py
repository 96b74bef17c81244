"""Which files of a folder are its current state, where files cannot be renamed into place.

On an object store a rename copies, so files are written beside those that are there, under
names of their own. One small object, replaced as a whole, lists the files that count; it
moves when all of them are there, and files it no longer lists go after that. Whoever
follows it sees the old state or the new one, whatever fails in between.
"""

from __future__ import annotations

import json

from tablelift.storage import Store

POINTER = "_current.json"
# Folders below an export that may have pointers: slices and increments, this deep.
DEPTH = 4


def current(store: Store, folder: str) -> list[str] | None:
    """Names of the files that count; None where no pointer was ever set."""
    text = store.read_text(f"{folder.rstrip('/')}/{POINTER}")
    return None if text is None else json.loads(text)["files"]


def move(store: Store, folder: str, names: list[str]) -> None:
    """From now on these files are the folder's state."""
    store.replace_text(f"{folder.rstrip('/')}/{POINTER}", json.dumps({"files": sorted(names)}))


def settle(store: Store, folder: str) -> list[str]:
    """The files that count before a write; a folder without a pointer gets one of all it has."""
    names = current(store, folder)
    if names is None:
        names = list(store.files(folder))
        if names:
            move(store, folder, names)
    return names


def put_aside(store: Store, folder: str, names: list[str]) -> None:
    """Delete the visible files of a folder that are not among ``names``."""
    for name in store.files(folder).keys() - set(names):
        store.delete(f"{folder.rstrip('/')}/{name}")


def current_files(store: Store, path: str) -> list[str] | None:
    """Paths of the files that count below ``path``; None if no pointer is there, so all do."""
    pointers = store.find(path, POINTER, DEPTH)
    if not pointers:
        return None
    listed = {p.rsplit("/", 1)[0]: current(store, p.rsplit("/", 1)[0]) or [] for p in pointers}
    free = [p for p in store.walk(path) if p.rsplit("/", 1)[0] not in listed]
    return free + [f"{folder}/{name}" for folder, names in listed.items() for name in names]
