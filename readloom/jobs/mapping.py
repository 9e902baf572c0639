"""A mapping run from a manifest of FASTQ files to alignments, coverage and summary."""

from __future__ import annotations

import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.config import MappingConfig
from readloom.functions import alignment as A
from readloom.functions.headers import qname
from readloom.jobs.store import StageStore, described, same_uri, uri
from readloom.operators import adapters, align, coverage, damage, limits, pairing, pairs, post, regions, reports, stats, trim
from readloom.sources import fastq, manifest, reference, sam
from readloom.sources.index import ReferenceIndex

log = logging.getLogger(__name__)

#: What names a pair: read names repeat across units.
_PAIR = ("unit_id", "qname")
#: Runs of the aligner that chunks are mapped in; each is kept once it is done.
_WAVES = 8


class MappingJob:
    def __init__(self, spark: SparkSession, config: MappingConfig):
        self.spark, self.config = spark, config
        self.store = StageStore(spark, f"{config.outdir}/{config.sample}.stages", config.resume)

    # --- inputs -----------------------------------------------------------------------------------------------

    def files(self) -> DataFrame:
        """idx, path of the manifest."""
        return manifest.read_manifest(self.spark, self.config.manifest)

    def paths(self) -> list[str]:
        return [r["path"] for r in self.files().orderBy("idx").collect()]  # a list of files, not of reads

    def key(self, *names: str) -> str:
        """The key of a stage: settings, and the files as they are now, so a changed file under its old path counts."""
        files = [self.config.manifest, *self.paths()] if "manifest" in names else []
        files += [self.config.reference] if "reference" in names else []
        return self.config.key(*names, inputs=tuple(described(self.spark, f) for f in files))

    def validate(self) -> int:
        """Reads every file to its end; returns the number of lines. Writes nothing."""
        return manifest.check_gzip(self.spark, self.paths())

    def explain(self) -> str:
        """The plan in words. Writes nothing."""
        c = self.config
        steps = ["manifest", "classify headers", "pair files", f"pilot {c.pilot_fragments}" if c.pilot_fragments else "", "trim and merge"]
        if not c.trim_only:
            steps += [f"map ({c.library_type})", f"mapq >= {c.min_mapq}", "mark duplicates", "read group", "coverage", "summary", "damage" if c.damage else ""]
        return " -> ".join(s for s in steps if s)

    def reset(self) -> None:
        self.store.reset()

    # --- stages -----------------------------------------------------------------------------------------------

    def reads(self) -> tuple[DataFrame, DataFrame]:
        """Units, and reads by unit_id, kind, mate, ordinal, qname, seq, qual."""
        c, files = self.config, self.files()
        raw = self.store.run("reads", self.key("manifest"), lambda: fastq.read_fastq(self.spark, self.paths()))
        listed = [(r["idx"], uri(self.spark, r["path"])) for r in files.orderBy("idx").collect()]  # a row per file
        if len({name for _, name in listed}) < len(listed):
            raise ValueError("a file stands in the manifest twice")
        listed = self.spark.createDataFrame(listed, "idx long, name string")
        named = raw.withColumn("name", same_uri(F.col("path")))
        headers = fastq.file_headers(named.withColumnRenamed("path", "full").withColumnRenamed("name", "path"))
        described = pairing.describe(headers.join(listed.select("idx", F.col("name").alias("path")), "path"))
        problems = pairing.conflicts(described).limit(10).collect()
        if problems:
            raise ValueError("; ".join(f"{p['key']}: {p['problem']}" for p in problems))
        units = pairing.units(described.select("idx", "key", "direction"))
        of = units.select("unit_id", "kind", F.posexplode(F.array("idx1", "idx2")).alias("mate", "idx")).where("idx is not null")
        placed = of.join(listed, "idx").select("unit_id", "kind", (F.col("mate") + 1).alias("mate"), "name")
        reads = named.join(placed, "name").select("unit_id", "kind", "mate", "ordinal", qname(F.col("header")).alias("qname"), "seq", "qual")
        counts = described.select("idx", "path").join(limits.read_counts(named, "name").withColumnRenamed("name", "path"), "path")
        uneven = pairing.count_mismatches(units.where("kind = 'PE'"), counts).limit(10).collect()
        if uneven:
            raise ValueError("; ".join(f"{u['unit_id']}: {u['reads1']} and {u['reads2']} reads" for u in uneven))
        return units, limits.pilot(reads, c.pilot_fragments)

    def trim(self) -> tuple[DataFrame, DataFrame]:
        """Trimmed reads, and the row of raw counts."""
        c = self.config
        units, reads = self.reads()

        def make() -> DataFrame:
            pe = reads.where("kind = 'PE'")
            mated = limits.mates(pe.where("mate = 1"), pe.where("mate = 2"))
            singles = reads.where("kind = 'SE'")
            # mates that reach into an adapter overlap, and are cut where the fragment ends; single reads have to be told
            found = None if c.adapter_r1 else self.store.run("adapters", self.key("manifest", "pilot_fragments"), lambda: adapters.detect_adapters(singles))
            return trim.trim_pairs(mated, c.min_length, c.adapter_r1, c.adapter_r2).unionByName(trim.trim_singles(singles, c.min_length, c.adapter_r1, found))

        trimmed = self.store.run("trimmed", self.key("manifest", "pilot_fragments", "min_length", "adapter_r1", "adapter_r2"), make)
        counts = self.store.run("raw-counts", self.key("manifest", "pilot_fragments", "min_length", "adapter_r1", "adapter_r2"), lambda: stats.raw_counts(reads, trimmed))
        report = reports.trim_report(reads, trimmed)
        whole = reports.as_json(report, reports.by_cycle(reads), reports.by_cycle(trimmed))
        whole.repartition("unit_id").write.mode("overwrite").partitionBy("unit_id").text(f"{c.outdir}/{c.sample}.trim_reports")
        self.seq_mode = pairing.sequencing_mode(units).first()["seq_mode"]
        return trimmed, counts

    def align(self, trimmed: DataFrame, contigs: DataFrame) -> DataFrame:
        """unit_id, chunk_id and the columns of SAM, unmapped reads included. Merged, unpaired and single reads are
        mapped alone; unmerged pairs are left out for ancient-fast."""
        c = self.config
        single = F.col("read_class") != "unmerged"
        used = trimmed.where(single) if c.library_type == "ancient-fast" else trimmed
        used = used.withColumn("read_id", F.concat_ws(":", "unit_id", "ordinal", "mate")).withColumn("single", single)
        index = ReferenceIndex(contigs, f"{self.store.folder}/index")
        if c.library_type == "modern":
            ends = used.where("not single").withColumn("pair_id", F.concat_ws(":", "unit_id", "ordinal"))
            together = pairs.align_pairs(ends.select("pair_id", "mate", "seq"), contigs, index).withColumn("read_id", F.concat_ws(":", "pair_id", "mate"))
            alone = align.align_modern(used.where("single"), contigs, index=index)
            placed = alone.unionByName(together.select(*alone.columns))
        else:
            placed = align.align_ancient(used, contigs, c.mismatch, index)
        whole = placed.join(used.select("read_id", "unit_id", "chunk_id", "qname", "mate", "single", "seq", "qual"), "read_id")
        alone = whole.where("single")
        paired = align.as_pairs(whole.where("not single"), by=_PAIR)
        back = A.has(F.col("flag"), A.REVERSE)
        return alone.unionByName(paired).select(
            "unit_id", "chunk_id", "qname", "flag", "rname", "pos", "mapq", "cigar", F.lit("*").alias("rnext"), F.lit(0).cast("long").alias("pnext"), F.lit(0).cast("long").alias("tlen"),
            F.when(back, A.reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"), F.when(back, F.reverse("qual")).otherwise(F.col("qual")).alias("qual"),
            F.create_map(F.lit("NM"), F.concat(F.lit("i:"), F.coalesce("mm", F.lit(0)))).alias("tags"),
        )

    def run(self) -> DataFrame:
        """Writes all outputs under outdir and returns the summary's row."""
        c = self.config
        log.info("run: %s", self.explain())
        trimmed, counts = self.trim()
        settings = {"sample": c.sample, "library_type": c.library_type, "seq_mode": self.seq_mode, "pilot_fragments": c.pilot_fragments, "max_reads_per_chunk": c.chunk_reads, "mapq": c.min_mapq}
        if c.trim_only:
            return self._table("stats", stats.trim_only_summary(settings, counts))
        lines = self.store.run("reference", self.key("reference"), lambda: reference.read_fasta(self.spark, c.reference))
        contigs = self.store.run("contigs", self.key("reference"), lambda: reference.lengths(lines))
        used = ("manifest", "reference", "pilot_fragments", "min_length", "adapter_r1", "adapter_r2", "library_type", "mismatch")
        chunked = trimmed.withColumn("chunk_id", limits.chunk_id(F.col("ordinal"), c.chunk_reads))
        chunks = self._table("chunks", limits.chunk_ids(chunked))

        def some(wanted: DataFrame) -> DataFrame:
            part = chunked.join(F.broadcast(wanted), ["unit_id", "chunk_id"])  # a row per chunk of a wave
            return self.align(part, lines)

        aligned = self.store.run_in_chunks("aligned", self.key(*used, "chunk_reads"), chunks, some, _WAVES if c.chunk_reads else 1).drop("chunk_id")
        if c.emit_unmapped:
            lost = post.route_unmapped(aligned, c.legacy_unmapped_routing, _PAIR)
            fastq.write_pairs(post.unmapped_pairs(lost, _PAIR), f"{c.outdir}/{c.sample}.unmapped", _PAIR)

        def mark() -> DataFrame:
            good = post.confident(post.mapped(aligned), c.min_mapq)
            if c.library_type != "ancient-fast" and self.seq_mode != "SE":
                good = post.fix_mates(good, _PAIR)
            return post.with_read_group(post.mark_duplicates(good, A.quality_score(F.col("qual")), c.dedup_fragment_ends, _PAIR), c.sample)

        marked = self.store.run("marked", self.key(*used, "min_mapq", "dedup_fragment_ends", "sample"), mark)
        self._table("duplicates", post.duplicate_report(marked))
        final = post.coordinate_sorted(post.deduplicated(marked), contigs).drop("unit_id")
        regions.write_regions(final, f"{c.outdir}/{c.sample}.final.RG")
        sam.write_sam(final, contigs, f"{c.outdir}/{c.sample}.final.RG.sam", c.sample)
        if c.damage:
            reads = post.deduplicated(marked)
            over = align.with_reference(reads, lines)
            found = damage.substitutions_under_cigars(over)
            for name, part in (("substitutions", found), ("profile", damage.damage_profile(found)), ("lengths", damage.fragment_lengths(reads)), ("composition", damage.base_composition(over))):
                part.coalesce(1).write.mode("overwrite").csv(f"{c.outdir}/{c.sample}_damage/{name}", sep="\t", header=True)
        depth = coverage.coverage_by_contig(post.deduplicated(marked), contigs, c.min_mapq)
        self._table("coverage", depth)
        return self._table("stats", stats.summary(settings, counts, stats.mapping_statistics(marked), coverage.weighted_coverage(depth)))

    def _table(self, name: str, rows: DataFrame) -> DataFrame:
        """Writes a small table as TSV, with numbers as the summary prints them."""
        six, two = ("endog", "duprate", "avg_depth", "pct_covered"), ("avg_readlen",)
        shown = rows.select(*[F.format_string("%.6f", F.col(c).cast("double")).alias(c) if c in six else F.format_string("%.2f", F.col(c).cast("double")).alias(c) if c in two else F.col(c) for c in rows.columns])
        shown.coalesce(1).write.mode("overwrite").csv(os.path.join(self.config.outdir, f"{self.config.sample}.{name}"), sep="\t", header=True)
        return rows
