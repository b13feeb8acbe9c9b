"""Command line of the dataset preparation."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import functions as F

from ..operators import filters, partitioning
from ..sources import datasets, replacements
from . import config
from .prepare import PrepareConfig, prepare

log = logging.getLogger(__name__)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="voxloom-prepare", description="Prepare a speech dataset from entry folders.")
    add = p.add_argument
    add("input_folder", nargs="?")
    add("--config")
    add("--max_source_entries", type=int)
    add("--audio_filename_glob", default="audio.*")
    add("--segments_filename_glob", default="transcript.*.json")
    add("--max_duration", type=float, default=30)
    add("--min_duration", type=float, default=5)
    add("--target_duration", type=float)
    add("--slice_length", type=float, help="older name of --max_duration, used if that has its default")
    add("--validation_split_size", type=float, default=0)
    add("--num_proc", type=int, default=1)
    add("--per_proc_per_chunk_size", type=int, default=10)
    add("--per_sample_quality_threshold", type=float, default=0)
    add("--per_segment_quality_threshold", type=float, default=0)
    add("--copy_metadata_fields", nargs="*", default=[])
    add("--exclude_by_md", nargs="*", default=[], metavar="PATH:eq:VALUE")
    add("--push_to_hub", action="store_true")
    add("--output_dataset_name", help="where to write; without it the rows are only counted")
    add("--dataset_name")
    add("--dataset_license_file")
    add("--dataset_version")
    add("--dataset_card_language")
    add("--dataset_card_license")
    add("--dataset_card_language_creators", nargs="*")
    add("--dataset_card_task_categories", nargs="*")
    add("--dataset_card_pretty_name")
    add("--push_as_public", action="store_true")
    add("--clear_output_dataset_cache_files", action="store_true")
    add("--log_level", default="INFO")
    add("--word_replacements", help="tab-separated table SOURCE, TARGET")
    add("--seed", type=int, default=0)
    add("--quarantine_folders", action="store_true", help="leave out folders without exactly one audio and one metadata file instead of stopping")
    add("--hub_root", help="folder that stands for the remote hub")
    return p


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = build_parser()
    args = p.parse_args(argv)
    args = config.merge_config(args, p, config.load_config(args.config))
    if not args.input_folder:
        p.error("an input folder is needed, here or in the configuration")
    if not isinstance(logging.getLevelName(str(args.log_level).upper()), int):
        raise ValueError(f"no such log level: {args.log_level}")
    if args.slice_length is not None and args.max_duration == p.get_default("max_duration"):
        args.max_duration = args.slice_length
    args.exclude_filters = tuple(filters.parse_exclusion(x) for x in args.exclude_by_md)
    return args


def run(spark, args: argparse.Namespace) -> dict[str, int] | None:
    """Prepare, split, write and push as the arguments say; rows per split, or None if there are none."""
    c = PrepareConfig(
        args.input_folder, float(args.max_duration), float(args.min_duration), args.target_duration, args.max_source_entries, args.audio_filename_glob, args.segments_filename_glob, num_proc=args.num_proc,
        per_proc_per_chunk_size=args.per_proc_per_chunk_size, per_sample_quality_threshold=args.per_sample_quality_threshold, per_segment_quality_threshold=args.per_segment_quality_threshold,
        copy_metadata_fields=tuple(args.copy_metadata_fields), exclude_filters=args.exclude_filters, seed=args.seed, strict_folders=not args.quarantine_folders, replacements=replacements.load_replacements(spark, args.word_replacements),
    )
    prepared = prepare(spark, c)
    examples = prepared.examples
    if args.validation_split_size:
        split = partitioning.exact_split(prepared.keys, "_key", args.validation_split_size, args.seed)
        examples = prepared.keyed.join(F.broadcast(split) if split.count() < 100_000 else split, "_key").drop("_key")
    counts = datasets.write_dataset(
        examples, args.output_dataset_name, args.dataset_name, args.dataset_version, args.dataset_license_file, language=args.dataset_card_language, license=args.dataset_card_license,
        language_creators=args.dataset_card_language_creators, task_categories=args.dataset_card_task_categories, pretty_name=args.dataset_card_pretty_name,
    )
    left_out = datasets.write_quarantine(prepared.quarantine, args.output_dataset_name)
    if left_out:
        log.warning("%d entries left out because of an error", left_out)
    if counts is None:
        log.warning("no dataset was created")
    elif args.push_to_hub and args.output_dataset_name and args.hub_root:
        if not args.push_as_public:
            log.warning("pushed as private")
        datasets.Hub(args.hub_root).push(args.output_dataset_name, args.dataset_name or "dataset", args.push_as_public)
    if args.clear_output_dataset_cache_files:
        spark.catalog.clearCache()
    for split, n in (counts or {}).items():
        log.info("%s: %d examples", split, n)
    return counts


def main(argv: list[str] | None = None) -> int:
    from pyspark.sql import SparkSession

    args = parse(argv)
    logging.basicConfig(level=str(args.log_level).upper())
    spark = SparkSession.builder.appName("voxloom-prepare").getOrCreate()
    return 0 if run(spark, args) else 1


if __name__ == "__main__":
    raise SystemExit(main())
