"""python -m readloom.jobs --manifest ... --prefix ... --ref ... --outdir ...: a mapping run from the command line."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from readloom.config import LIBRARY_TYPES, MappingConfig
from readloom.jobs.mapping import MappingJob


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="readloom", description="Maps reads and summarises the result.")
    for name in ("manifest", "prefix", "ref", "outdir"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--library-type", choices=LIBRARY_TYPES, default="modern")
    for name, default in (("minlength", 30), ("mapq", 20), ("max-reads-per-chunk", 0), ("pilot-fragments", 0)):
        p.add_argument(f"--{name}", type=int, default=default)
    p.add_argument("--mismatch", type=float, default=0.01)
    for name in ("adapter-r1", "adapter-r2"):
        p.add_argument(f"--{name}", default="")
    for name in ("emit-unmapped-fastq", "trim-only", "run-mapdamage", "keep-intermediate", "dry-run", "validate", "reset"):
        p.add_argument(f"--{name}", action="store_true")
    p.add_argument("--no-resume", dest="resume", action="store_false")
    for name in ("resume", "no-emit-unmapped-fastq", "no-mapdamage", "delete-as-you-go", "no-delete-as-you-go"):
        p.add_argument(f"--{name}", dest="ignored", action="store_true", help=argparse.SUPPRESS)
    return p


def config(args: argparse.Namespace) -> MappingConfig:
    return MappingConfig(
        sample=args.prefix, manifest=args.manifest, reference=args.ref, outdir=args.outdir, library_type=args.library_type, min_length=args.minlength,
        mismatch=args.mismatch, min_mapq=args.mapq, chunk_reads=args.max_reads_per_chunk, pilot_fragments=args.pilot_fragments, adapter_r1=args.adapter_r1,
        adapter_r2=args.adapter_r2, trim_only=args.trim_only, emit_unmapped=args.emit_unmapped_fastq, damage=args.run_mapdamage, resume=args.resume,
        keep_intermediate=args.keep_intermediate,
    )


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="[%(asctime)s] %(message)s")
    job = MappingJob(SparkSession.builder.appName(f"readloom {args.prefix}").getOrCreate(), config(args))
    if args.dry_run:
        print(job.explain())
    elif args.validate:
        print(job.validate(), "lines")
    else:
        if args.reset:
            job.reset()
        job.run().show(truncate=False, vertical=True)
        if not args.keep_intermediate:
            job.reset()
    return 0


if __name__ == "__main__":
    sys.exit(main())
