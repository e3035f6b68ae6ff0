"""Where raw files lie and exports go, from environment settings."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Words that switch TLS on.
_ON = ("1", "true", "yes", "y", "on")

# Settings an object store needs.
_STORE_SETTINGS = ("MINIO_ENDPOINT", "MINIO_ACCESS_KEY", "MINIO_SECRET_KEY", "MINIO_BUCKET")


@dataclass(frozen=True)
class Location:
    """A folder, how files are looked up in it, and its file-system settings."""

    path: str
    recursive: bool = False
    ignore_case: bool = False
    storage: dict[str, str] = field(default_factory=dict)

    def landing_options(self) -> dict:
        return {
            "recursive": self.recursive,
            "ignore_case": self.ignore_case,
            "storage": self.storage,
        }


def _missing(env: Mapping[str, str]) -> list[str]:
    return [name for name in _STORE_SETTINGS if not env.get(name, "").strip()]


def _object_store(env: Mapping[str, str], prefix: str) -> Location:
    value = {name: env[name].strip() for name in _STORE_SETTINGS}
    secure = env.get("MINIO_SECURE", "").strip().lower() in _ON
    storage = {
        "fs.s3a.endpoint": value["MINIO_ENDPOINT"],
        "fs.s3a.access.key": value["MINIO_ACCESS_KEY"],
        "fs.s3a.secret.key": value["MINIO_SECRET_KEY"],
        "fs.s3a.path.style.access": "true",
        "fs.s3a.connection.ssl.enabled": str(secure).lower(),
    }
    path = f"s3a://{value['MINIO_BUCKET']}/{prefix.strip('/')}"
    return Location(path, recursive=True, ignore_case=True, storage=storage)


def source_location(env: Mapping[str, str]) -> Location:
    """Raw files on a mounted folder (``local``) or in an object store (``minio``).

    A folder is searched itself, with the pattern's case; an object store is
    searched below its prefix, in any case.
    """
    kind = env.get("DATA_SOURCE", "local").strip().lower()
    path = env.get("RAW_DATA_PATH", "data/raw")
    if kind == "local":
        return Location(path)
    if kind != "minio":
        raise ValueError(f"DATA_SOURCE is {kind!r}; it must be 'local' or 'minio'")
    if missing := _missing(env):
        raise ValueError("object store settings are missing: " + ", ".join(missing))
    return _object_store(env, path)


def export_location(env: Mapping[str, str]) -> Location | None:
    """Bucket for exports; None when its settings are incomplete."""
    return None if _missing(env) else _object_store(env, "")
