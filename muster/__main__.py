"""Run one full refresh: python -m muster <warehouse> [--source PATH] [--export PATH] ..."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging
import os

from muster.config import Config
from muster.plans.refresh import refresh
from muster.session import build_session
from muster.sources.locations import Location, export_location, source_location


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="muster", description=__doc__)
    parser.add_argument("warehouse", help="root folder of the layered tables")
    parser.add_argument("--source", help="folder of raw files (default: from the environment)")
    parser.add_argument("--export", help="folder for the exported tables (default: from the environment)")
    parser.add_argument("--settings", help="settings file (JSON, or YAML where PyYAML is installed)")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    parser.add_argument("--master", help="Spark master, for local runs")
    return parser.parse_args()


def _settings(path: str | None) -> dict:
    if path is None:
        return {}
    with open(path, encoding="utf-8") as file:
        if path.endswith((".yaml", ".yml")):
            import yaml  # optional dependency

            return yaml.safe_load(file)
        return json.load(file)


def main() -> None:
    args = _arguments()
    logging.basicConfig(level=logging.INFO)
    source = Location(args.source) if args.source else source_location(os.environ)
    target = Location(args.export) if args.export else export_location(os.environ)
    summary = refresh(
        build_session(master=args.master),
        source.path,
        args.warehouse,
        Config.from_settings(_settings(args.settings), as_of=args.as_of),
        export_path=target and target.path,
        export_storage=target and target.storage,
        **source.landing_options(),
    )
    print(summary)


if __name__ == "__main__":
    main()
