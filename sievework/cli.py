"""Command line of the curation run: python -m sievework.cli --settings sources.json --output-dir out."""

from __future__ import annotations

import argparse
import importlib
import json
from collections.abc import Callable
from pathlib import Path

from sievework.plans.curate import Config, run
from sievework.sources.registry import REGISTRY, Registry


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sievework", description="Curate instruction and code samples.")
    p.add_argument("--output-dir", default="data_formatted", help="folder of records and reports; its content is replaced")
    p.add_argument("--settings", help="JSON file: source name to its reader's settings")
    p.add_argument("--sources", nargs="+", help="only these sources")
    p.add_argument("--exclude", nargs="+", default=[], help="none of these sources")
    p.add_argument("--list-sources", action="store_true", help="print the sources and stop")
    p.add_argument("--augmentation", action="store_true", help="add prompt variants to the train rows")
    p.add_argument("--no-deduplicate", action="store_true", help="keep duplicates")
    p.add_argument("--test-ratio", type=float, default=0.1)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--quality-config", default="quality_config.json", help="JSON file of the rules; without it they are all on, and strict")
    p.add_argument("--no-quality-validation", action="store_true", help="skip the rules whatever the file says")
    p.add_argument("--quality-strict", action="store_true", help="HIGH issues reject too, whatever the file says")
    p.add_argument("--enable-rendering", action="store_true", help="render samples with --renderer")
    p.add_argument("--renderer", help="module:function of code to (ok, error)")
    p.add_argument("--rendering-timeout", type=int, default=30, help="seconds, given to the renderer")
    p.add_argument("--no-rendering-fixes", action="store_true", help="no second attempt with repaired code")
    p.add_argument("--rendering-full", nargs="?", const="rendered_videos", help="folder of whole videos, given to the renderer")
    p.add_argument("--rendering-fast", action="store_true", help="last frame only, given to the renderer")
    p.add_argument("--no-rendering-cache", action="store_true", help="render again what is there, given to the renderer")
    p.add_argument("--fill-descriptions", action="store_true", help="fill placeholder descriptions with --describer")
    p.add_argument("--describer", help="module:function of a list of codes to a list of descriptions")
    p.add_argument("--llm-config", help="JSON file: keyword arguments of the describer; `cache` names its cache table")
    p.add_argument("--fix-code", action="store_true", help="apply the repair rules")
    return p


def _json(path: str | None) -> dict:
    return json.loads(Path(path).read_text(encoding="utf-8")) if path and Path(path).exists() else {}


def _named(name: str | None, **kept) -> Callable | None:
    """The function that module:function names, with keyword arguments bound where there are some."""
    if not name:
        return None
    module, _, function = name.partition(":")
    found = getattr(importlib.import_module(module), function)
    return (lambda x: found(x, **kept)) if kept else found


def config(args: argparse.Namespace) -> Config:
    rules, model = _json(args.quality_config), _json(args.llm_config)
    given = Path(args.quality_config).exists()
    rendering = {"timeout": args.rendering_timeout, "videos": args.rendering_full, "fast": args.rendering_fast, "cache": not args.no_rendering_cache}
    return Config(
        output=args.output_dir,
        sources=_json(args.settings),
        wanted=args.sources,
        excluded=args.exclude,
        validate=not args.no_quality_validation and (args.quality_strict or rules.get("global_settings", {}).get("enable_quality_validation", False) if given else True),
        strict=args.quality_strict or (rules.get("global_settings", {}).get("quality_strict_mode", False) if given else True),
        quality=rules,
        deduplicate=not args.no_deduplicate,
        fix_code=args.fix_code,
        fill_descriptions=args.fill_descriptions,
        describe=_named(args.describer, **{k: v for k, v in model.items() if k != "cache"}),
        description_cache=model.get("cache"),
        render=_named(args.renderer, **rendering) if args.enable_rendering else None,
        render_fixes=not args.no_rendering_fixes,
        augment=args.augmentation,
        test_ratio=args.test_ratio,
        seed=args.seed,
    )


def listed(registry: Registry = REGISTRY) -> str:
    registry.discover()
    return "\n".join(f"{n}: {registry.get(n).title or n} (priority={registry.get(n).priority})" for n in registry.names())


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    if args.list_sources:
        print(listed())
        return
    if args.enable_rendering and not args.renderer:
        parser().error("--enable-rendering needs --renderer")
    from pyspark.sql import SparkSession

    run(SparkSession.builder.getOrCreate(), config(args))


if __name__ == "__main__":
    main()
