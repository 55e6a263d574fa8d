"""Command line: ``python -m cairn PROGRAM ...``.  Errors print ``ERROR:``; a run without input ends with 1, a wrong argument with 2."""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from pyspark.sql import SparkSession

from cairn.plans import hardcases, prepare, reports
from cairn.sources import files


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cairn")
    sub = p.add_subparsers(dest="command", required=True)

    def program(name: str, help: str, *arguments: tuple) -> None:
        one = sub.add_parser(name, help=help)
        for flags, options in arguments:
            one.add_argument(*flags.split(), **options)

    whole = lambda n: {"type": int, "default": n}
    out = ("--out-dir", {"default": "reports"})
    sets = ("datasets", {"nargs": "+", "metavar": "NAME=ROOT"})
    names = ("--names", {"nargs": "+", "required": True})
    program("run_prepare_pipeline", "clean, deduplicate and split sources", ("config", {"help": "JSON: names, and sources with name, root, prefix, mapping, drop, target, low, high"}), ("out", {}), ("--phash-threshold", whole(8)), ("--seed", whole(42)), ("--skip", {"nargs": "*", "default": []}), ("--only", {"nargs": "*"}))
    program("analyze_datasets", "profile folders of images and labels", sets, out, ("--hash-images", {"action": "store_true"}))
    program("class_distribution", "classes by split, from the first field of label lines", sets, out)
    program("check_leakage", "equal and similar images across splits", ("--merged-root", {"required": True}), ("--max-hamming", whole(8)), ("--out", {"default": "reports/leakage_report.md"}))
    program("merged_class_distribution", "classes of a merged set by split and source", ("root", {}), names, ("--sources", {"nargs": "*", "default": []}), out)
    program("generate_final_stats", "images and classes of a merged set", ("root", {}), names, out)
    program("report_invalid_boxes", "why boxes of a source fail", ("root", {}), ("--names", {"nargs": "*"}), out)
    program(
        "mine_hardcases", "crops of uncertain detections in videos", ("--videos", {"required": True}), ("--output", {"required": True}), ("--decoder", {"required": True, "metavar": "MODULE:NAME"}), ("--model", {"required": True, "metavar": "MODULE:NAME", "help": "makes a detector; its class_names are the model's"}),
        ("--mode", {"default": "civilian", "choices": ["civilian", "hardcase_all"]}), ("--conf", {"type": float, "default": 0.5}), ("--target-class", {"default": "civilian_vehicle"}), ("--class-id", {"type": int}), ("--uncertain-conf", {"type": float, "default": 0.6}), ("--uncertain-floor", {"type": float, "default": 0.25}),
        ("--frame-stride", whole(15)), ("--min-crop-px", whole(50)), ("--dedup-mode", {"default": "standard", "choices": ["standard", "aggressive"]}), ("--hash-threshold", {"type": int}), ("--cooldown-frames", {"type": int}), ("--hash-resize", whole(128)),
    )
    program("deduplicate", "one crop of each cluster", ("--crops", {"required": True}), ("--metadata", {}), ("--threshold", whole(5)), ("--hash-size", whole(8)), ("--output", {"required": True}))
    program("create_grid", "pages of crops", ("--crops", {"required": True}), ("--metadata", {}), ("--output", {"required": True}), ("--rows", whole(10)), ("--cols", whole(10)), ("--cell", whole(128)), ("--pad", whole(4)), ("--sort", {"default": "conf-asc", "choices": ["name", "conf-asc", "conf-desc"]}), ("--all-pages", {"action": "store_true"}))
    program("review_hardcases", "pending crops, or decisions of key strokes", ("--crops", {"required": True}), ("--review-csv", {"required": True}), ("--metadata", {}), ("--keys", {"help": "CSV of crop_file and key"}))
    program("export_reviewed_hardcases", "reviewed crops as a data set", ("--review-csv", {"required": True}), ("--places", {"nargs": "+", "required": True, "help": "folders of crops, the first that has one counts"}), ("--output", {"required": True}))
    program("merge_hardcases", "add exported crops to a merged set", ("--export", {"required": True}), ("--merged", {"required": True}), ("--split", {"default": "train"}), ("--prefix", {"default": "hc_"}))
    return p


def _named(pairs: list[str]) -> dict[str, str]:
    if any("=" not in x for x in pairs):
        raise ValueError("datasets are given as NAME=ROOT")
    return dict(x.split("=", 1) for x in pairs)


def _loaded(where: str):
    module, _, name = where.partition(":")
    return getattr(importlib.import_module(module), name)


def _source(s: dict) -> prepare.Source:
    return prepare.Source(s["name"], s["root"], s["prefix"], {int(x): y for x, y in s["mapping"].items()}, frozenset(s.get("drop", ())), s.get("target"), s.get("low", 0), s.get("high", 0))


def run(spark: SparkSession, o: argparse.Namespace) -> object:
    """What a program returns, for printing."""
    c = o.command
    if c == "run_prepare_pipeline":
        with open(o.config, encoding="utf-8") as f:
            config = json.load(f)
        sources = [s for s in map(_source, config["sources"]) if s.name not in o.skip]
        if not any(o.only is None or s.name in o.only for s in sources):
            raise LookupError("no source is left")
        return prepare.prepare(spark, sources, o.out, config["names"], o.phash_threshold, o.seed, o.only)
    if c == "analyze_datasets":
        return [{"name": x["name"], **x["totals"], **x["label_health"]} for x in reports.analysis(spark, _named(o.datasets), o.out_dir, o.hash_images)]
    if c == "class_distribution":
        return {k: len(v["instances"]) for k, v in reports.class_distribution(spark, _named(o.datasets), o.out_dir).items()}
    if c == "check_leakage":
        exact, near = prepare.leakage(spark, o.merged_root, o.max_hamming, o.out)
        return {"exact": exact.count(), "near": near.count(), "report": o.out}
    if c == "merged_class_distribution":
        return reports.merged_distribution(spark, o.root, o.names, o.sources, o.out_dir)
    if c == "generate_final_stats":
        return reports.final_statistics(spark, o.root, o.names, o.out_dir)
    if c == "report_invalid_boxes":
        return reports.invalid_boxes(spark, o.root, o.names, o.out_dir)
    if c == "mine_hardcases":
        model = _loaded(o.model)
        known = dict(model.class_names)
        rule = hardcases.mining_rule(o.mode, known, o.target_class, o.class_id, o.conf, below=o.uncertain_conf, floor=o.uncertain_floor)
        return hardcases.mine(spark, o.videos, o.output, _loaded(o.decoder), model, known, o.model, rule, o.frame_stride, o.min_crop_px, o.dedup_mode, o.hash_threshold, o.cooldown_frames, o.hash_resize)
    if c == "deduplicate":
        return hardcases.deduplicate_folder(spark, o.crops, o.metadata, o.output, o.threshold, o.hash_size)
    if c == "create_grid":
        return {"pages": hardcases.write_grid(spark, o.crops, o.metadata, o.output, o.sort, o.rows, o.cols, o.cell, o.pad, o.all_pages)}
    if c == "review_hardcases":
        crops = hardcases.scan_crops(spark, o.crops)
        if o.keys:
            known = crops.withColumn("confidence", hardcases.B.confidence_from_name(crops["crop_file"]))
            hardcases.append_events(hardcases.events(spark.read.csv(o.keys, header=True), known), o.review_csv)
        log = hardcases.read_log(spark, o.review_csv)
        table = files.read_csv(spark, o.metadata, files.CROPS) if o.metadata else None
        return {"decisions": hardcases.decision_counts(log), "pending": hardcases.pending(crops, log, table).count()}
    if c == "export_reviewed_hardcases":
        return hardcases.export(spark, o.review_csv, o.places, o.output)
    return hardcases.merge(spark, o.export, o.merged, o.split, o.prefix)


def main(args: list[str] | None = None) -> int:
    o = _parser().parse_args(args)
    spark = SparkSession.builder.appName("cairn").getOrCreate()
    try:
        print(json.dumps(run(spark, o), indent=2, default=str))
    except LookupError as e:
        print(f"ERROR: {e}", file=sys.stderr)
        return 1
    except ValueError as e:
        print(f"ERROR: {e}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
