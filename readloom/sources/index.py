"""A reference's k-mers, stored once under the digest of the reference and joined where they lie."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions.packed import WORD, Packed, minimizers
from readloom.operators.stored import few, shared_folder, without_leftovers
from readloom.sources.reference import windows

#: Bases of a piece that k-mers are taken from, besides what stands around it.
STEP = 1024
#: Words of a filter of keys: 32 MB at most.
WORDS = 1 << 22
_ROW = "key long, rname string, pos long, before long, after long, lead int, tail int, odd boolean"


def _spots(keys: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The word of a filter that each key falls on, and its two bits there."""
    x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    bit = lambda shift: np.uint64(1) << (x >> np.uint64(shift) & np.uint64(63))
    return (x & np.uint64(words - 1)).astype(np.int64), bit(22) | bit(28)


def may_be(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether keys may be among those of ReferenceIndex.filter(): never False for one that is."""
    at, bits = _spots(keys, len(words))
    return words[at] & bits == bits


class ReferenceIndex:
    """k-mers of contigs (rname, seq, or lines as read_fasta() gives them), or their minimizers among w, as tables bucketed by key.

    A row has the k-mer's place, the 32 bases before and after it, two bits each, how many of them the contig has, and
    whether other letters are among these or in the k-mer. A k-mer with one other letter, which is
    a mismatch to any base, has a row for each base there (minimizers have none). Keys with more than `heavy` places are a row without place in that table,
    which counts their parts; the parts are in a table of their own, so that no key has more than about `heavy` rows.
    Tables are made once, under folder (the session's shared folder by default), by digest, k and w.
    """

    def __init__(self, contigs: DataFrame, folder: str | None = None, heavy: int = 256):
        self.contigs, self.heavy, self.spark = contigs, heavy, contigs.sparkSession
        self.folder = folder or f"{shared_folder(self.spark)}/index"
        self.made: list[str] = []
        self._filters: dict[tuple[int, int], Broadcast] = {}
        self._marks: dict[tuple[int, int], tuple[DataFrame, int]] = {}

    @cached_property
    def _told(self) -> tuple[str, int]:
        """The digest of all contigs and how many bases they have, from one row."""
        name = F.coalesce(F.col("rname"), F.lit(""))
        parts = ["seq"] if "seq" in self.contigs.columns else ["offset", "bases"]
        row = self.contigs.select(F.length(parts[-1]).cast("long").alias("n"), *[F.xxhash64(F.lit(i), name, *parts).alias(f"h{i}") for i in (1, 2)]).agg(
            F.count("*").alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("bases"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"),
            F.sum(F.pmod("h1", F.lit(1 << 31))).alias("s1"), F.sum(F.pmod("h2", F.lit(1 << 31))).alias("s2"),
        ).first()
        return hashlib.sha256(repr((tuple(row), self.heavy)).encode()).hexdigest()[:24], int(row["bases"])

    @property
    def bases(self) -> int:
        return self._told[1]

    @property
    def buckets(self) -> int:
        return max(16, -(-self.bases >> 20))

    def _rows(self, k: int, w: int) -> DataFrame:
        pieces = windows(self.contigs, STEP, 2 * WORD + k - 1).select("rname", "start", "bases").repartition("rname", "start")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                p = Packed.of_strings(batch.column(2))
                begin = batch.column(1).to_numpy()
                if w > 1:
                    at, of = minimizers(p, k, w)
                else:
                    many = np.maximum(p.size - k + 1, 0)
                    of = np.repeat(np.arange(len(many)), many)
                    at = np.repeat(p.begin - (np.cumsum(many) - many), many) + np.arange(len(of))
                local = at - p.begin[of]
                own = (local >= np.where(begin[of] > 1, WORD, 0)) & (local < STEP + WORD)
                at, of, local = at[own], of[own], local[own]
                plain = np.flatnonzero(p.plain(at, k))
                near, near_keys = p.one_odd(at, k) if w == 1 else (plain[:0], plain[:0])
                key, which = np.concatenate([p.keys(at[plain], k), near_keys]), np.concatenate([plain, near])
                at, of, local = at[which], of[which], local[which]
                lead, tail = np.minimum(local, WORD), np.minimum(p.size[of] - local - k, WORD)
                odd = ~p.plain(at - lead, lead + k + tail)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), batch.column(0).take(pa.array(of)), pa.array(begin[of] + local), pa.array(p.word[at - WORD].view(np.int64)), pa.array(p.word[at + k].view(np.int64)),
                     pa.array(lead, pa.int32()), pa.array(tail, pa.int32()), pa.array(odd)], names=[x.split()[0] for x in _ROW.split(", ")],
                )

        return pieces.mapInArrow(run, _ROW)

    def _path(self, k: int, w: int, part: str) -> str:
        return f"{self.folder}/{self._told[0]}/k{k}w{w}{part}"

    def _done(self, path: str) -> bool:
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return bool(mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(mark))

    def name(self, k: int, w: int = 1) -> str:
        """What the session's catalog calls the table: a name for each place that it is stored in."""
        return f"readloom_index_{hashlib.sha256(self._path(k, w, '').encode()).hexdigest()[:24]}"

    def table(self, k: int, w: int = 1) -> tuple[DataFrame, DataFrame]:
        """The table by key (rname null and parts for heavy keys), and the heavy keys' rows with their part."""
        heavy, path = self._path(k, w, "heavy"), self._path(k, w, "")
        name = self.name(k, w)
        spec = f"({_ROW}, parts long) using parquet clustered by (key) sorted by (key) into {self.buckets} buckets location '{path}'"
        if not self._done(path) or not self._done(heavy):
            self.made.append(f"k{k}w{w}")
            rows = self._rows(k, w)
            many, _ = few(rows.groupBy("key").count().where(F.col("count") > self.heavy).select("key", F.ceil(F.col("count") / self.heavy).alias("parts")), "heavy-keys")
            of = rows.join(many, "key").withColumn("part", F.pmod(F.xxhash64("rname", "pos"), F.col("parts"))).drop("parts")
            mark = many.select("key", *[F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in _ROW.split(", ")[1:])], "parts")
            light = rows.join(many, "key", "left_anti").withColumn("parts", F.lit(None).cast("long")).unionByName(mark)
            self.spark.sql(f"drop table if exists {name}")
            with without_leftovers(self.spark):
                of.write.mode("overwrite").option("compression", "zstd").parquet(heavy)
                light.repartition(self.buckets, "key").write.mode("overwrite").option("compression", "zstd").bucketBy(self.buckets, "key").sortBy("key").option("path", path).format("parquet").saveAsTable(name)
        else:
            self.spark.sql(f"create table if not exists {name} {spec}")
        return self.spark.table(name), self.spark.read.parquet(heavy)

    def filter(self, k: int, w: int = 1) -> Broadcast:
        """Words that tell which keys the table may have, two bits a key: WORDS at most, whatever the reference. Seeds
        that it rules out, as most neighbours of a k-mer and most of the wrong strand's, are never shuffled."""
        if (k, w) not in self._filters:
            words = min(WORDS, 1 << max(10, (self.bases >> 2).bit_length()))

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    at, bits = _spots(batch.column(0).to_numpy(), words)
                    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits.view(np.int64))], names=["at", "bits"])

            with without_leftovers(self.spark):
                told = self.table(k, w)[0].select("key").mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
            filled = np.zeros(words, np.uint64)
            filled[told.column("at").to_numpy()] = told.column("bits").to_numpy().view(np.uint64)
            self._filters[k, w] = self.spark.sparkContext.broadcast(filled)
        return self._filters[k, w]

    def hits(self, seeds: DataFrame, k: int, w: int = 1, salts: int = 8) -> DataFrame:
        """seeds (read_id, key and others) with the index's columns, a row for each place of the key.

        The index isn't shuffled: seeds go to its buckets. Heavy keys' seeds are told by a broadcast of these keys,
        if there are any, and go to their parts, salted by read, through a join that AQE may split further. A bucket has
        about a million rows, which are hashed, so neither side is sorted.
        """
        table, heavy = self.table(k, w)
        light = seeds.join(table.where("rname is not null").drop("parts").hint("shuffle_hash"), "key")
        if (k, w) not in self._marks:
            self._marks[k, w] = few(table.where("rname is null").select("key", "parts"), "heavy-marks")
        marks, many = self._marks[k, w]
        if not many:
            return light
        part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
        marked = seeds.join(marks, "key").select(*seeds.columns, part, F.pmod(F.xxhash64("read_id"), F.lit(salts)).alias("salt"))
        copies = heavy.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        return light.unionByName(marked.join(copies, ["key", "part", "salt"]).select(*light.columns))
