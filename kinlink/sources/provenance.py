"""Manifests, digests and guards of runs, on the driver."""

from __future__ import annotations

import hashlib
from pathlib import Path


def sha256_file(path: str | Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def sha256_folder(path: str | Path) -> str:
    """Of the files' relative names and contents; checksum side files do not count."""
    total = hashlib.sha256()
    for p in sorted(x for x in Path(path).rglob("*") if x.is_file() and not x.name.endswith(".crc")):
        total.update(f"{p.relative_to(path)}\0{sha256_file(p)}\n".encode())
    return total.hexdigest()


def code_files() -> dict[str, Path]:
    """The linkage engine's own files; operators of other kinds are no part of a run."""
    root = Path(__file__).resolve().parents[1]
    found = {str(p.relative_to(root)): p for p in sorted(root.rglob("*.py"))}
    return {n: p for n, p in found.items() if n.split("/")[0] in ("__init__.py", "functions", "operators", "plans", "sources", "streaming")}


def sha256_code() -> str:
    total = hashlib.sha256()
    for name, path in code_files().items():
        total.update(f"{name}\0{sha256_file(path)}\n".encode())
    return total.hexdigest()


def input_names(splits=("train", "test")) -> list[str]:
    names = [f"{s}/{s}_source{n}.tsv" for s in splits for n in (1, 2, 3)]
    return names + ["train/train_ground_truth.tsv"] * ("train" in splits)


def check_inputs(data: str | Path, splits=("train", "test")) -> None:
    """Fail before any heavy work if an input is missing, empty or has another header."""
    from .tsv import SOURCE_HEADER, TRUTH_HEADER

    for name in input_names(splits):
        path = Path(data, name)
        if not path.is_file() or not path.stat().st_size:
            raise ValueError(f"{path}: no such file, or nothing in it")
        with path.open(encoding="utf-8", newline="") as f:
            header = f.readline().rstrip("\r\n").split("\t")
        if header != (TRUTH_HEADER if "ground_truth" in name else SOURCE_HEADER):
            raise ValueError(f"{path}: the header names other columns")


def input_manifest(data: str | Path, splits=("train", "test")) -> dict:
    paths = {name: Path(data, name) for name in input_names(splits)}
    return {n: {"bytes": p.stat().st_size, "sha256": sha256_file(p)} for n, p in paths.items()}


def check_write_paths(data: str | Path, *paths: str | Path | None) -> None:
    """Nothing may be written inside the data folder, not even through a link."""
    root = Path(data).resolve()
    for p in paths:
        if p is not None and Path(p).resolve().is_relative_to(root):
            raise ValueError(f"{p} is inside the input folder")


def check_options(**options: int) -> None:
    for name, value in options.items():
        if not isinstance(value, int) or value < 1:
            raise ValueError(f"option {name}: {value!r} is no count from 1 up")
    if options.get("keep", 1) > options.get("mod", options.get("keep", 1)):
        raise ValueError("of mod parts, at most mod can be kept")
