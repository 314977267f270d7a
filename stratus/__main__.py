"""Command line: `python -m stratus {batch|incremental|raw-incremental} ...`."""

from __future__ import annotations

import sys


def main(argv: list[str] | None = None) -> None:
    argv = list(sys.argv[1:] if argv is None else argv)
    commands = {"batch": "stratus.plans.batch", "incremental": "stratus.streaming.incremental",
                "raw-incremental": "stratus.streaming.raw_ingest"}
    if not argv or argv[0] not in commands:
        print("usage: python -m stratus {batch|incremental|raw-incremental} [options]  (--help per command)")
        raise SystemExit(2)
    import importlib
    importlib.import_module(commands[argv[0]]).main(argv[1:])


if __name__ == "__main__":
    main()
