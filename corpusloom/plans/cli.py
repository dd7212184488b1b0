"""python -m corpusloom.plans.cli STAGE --config FILE [--run-id ID] [--resume] [--set a.b=value ...]"""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import SparkSession

from ..sources.artifacts import load_config
from .pipeline import STAGES


def overrides(pairs: list[str]) -> dict:
    out: dict = {}
    for pair in pairs:
        key, _, value = pair.partition("=")
        node = out
        *path, last = key.split(".")
        for k in path:
            node = node.setdefault(k, {})
        try:
            node[last] = json.loads(value)
        except ValueError:
            node[last] = value
    return out


def main(argv: list[str] | None = None) -> str | None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("stage", choices=sorted(STAGES))
    parser.add_argument("--config", type=Path)
    parser.add_argument("--run-id")
    parser.add_argument("--resume", action="store_true")
    parser.add_argument("--stop-after-merges", type=int)
    parser.add_argument("--set", action="append", default=[], metavar="KEY=VALUE", help="dotted key of the configuration; JSON value")
    args = parser.parse_args(argv)
    defaults, stage = STAGES[args.stage]
    cfg = load_config(args.config, defaults, overrides(args.set))
    extra = {"stop_after": args.stop_after_merges} if args.stage == "tokenizer" and args.stop_after_merges is not None else {}
    name = stage(SparkSession.builder.getOrCreate(), cfg, args.run_id, args.resume, **extra)
    print(name)
    return name


if __name__ == "__main__":
    main()
