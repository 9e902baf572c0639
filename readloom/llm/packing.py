"""Best-fit packing: shards of pieces are packed best-fit, nearly full bins leave, and the others meet as items of
further best-fit rounds up a tree.

Of the bins that best-fit leaves in one shard, any two together exceed a sequence, so at most one is half empty.
What a merge of shards can still gain is to place those few bins, and the emptiest bins of each shard can host
them whenever any can. A shard therefore hands on its `carry` emptiest bins, a bounded number, and loses nothing.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage_table

#: White space other than a blank and a line feed, by any reading of the term.
_OTHER_SPACE = "[\t\x0b\x0c\r\x1c-\x1f\x85\xa0  -     　]"

#: Letters that a mark ends the word after.
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


class CachedEncoder:
    """Token ids as little-endian 32-bit bytes, with those of blank-separated parts remembered.

    Where blanks stand alone the vocabulary's pre-tokenizer never reaches across one backwards, so a text's ids are
    those of its parts, each with its blank, one after another. So it is with single line feeds within a part, and with
    one mark after a letter at the end of a line or part. Words not yet known are encoded together, and the tokens that
    begin with a blank or are a line feed tell them apart. Other texts are encoded whole.
    """

    def __init__(self, path: str, most: int = 1_500_000, longest: int = 48):
        import re

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.longest = Tokenizer.from_file(path), most, longest
        self.known: dict[str, bytes] = {}  # of parts with a blank before them, and of words with a line feed before them
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.other_space = re.compile(_OTHER_SPACE).search
        self.marks = {m: self._whole(m) for m in ".,;:!?"}
        vocabulary = self.tokenizer.get_vocab()
        self.blank = np.zeros(max(vocabulary.values()) + 1, bool)
        self.blank[[i for t, i in vocabulary.items() if t[0] == "\u0120"]] = True  # how the vocabulary writes a blank
        self.feed = self.blank.copy()
        self.feed[vocabulary["\u010a"]] = True  # and a line feed

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _encode(self, keys: list[str], begins: np.ndarray, at_once: int = 1000) -> None:
        """Adds the ids of keys, which are words with a line feed before them, or get a blank."""
        groups = [keys[a : a + at_once] for a in range(0, len(keys), at_once)]
        spaced = [[k if k[0] == "\n" else " " + k for k in g] for g in groups]
        for group, own, out in zip(groups, spaced, self.tokenizer.encode_batch_fast(["".join(x) for x in spaced], add_special_tokens=False), strict=True):
            ids = np.array(out.ids, dtype="<u4")
            cuts = (4 * np.flatnonzero(begins[ids])).tolist()
            if len(cuts) != len(group):
                self.known.update(zip(group, map(self._whole, own), strict=True))
                continue
            flat = ids.tobytes()
            self.known.update(zip(group, [flat[a:b] for a, b in zip(cuts, [*cuts[1:], len(flat)], strict=True)], strict=True))

    def _learn(self, missing: set[str]) -> list[str]:
        """Adds the ids of parts that aren't known, from their words; returns what is too long to be kept."""
        known, marks, words, odd, marked, lined = self.known, self.marks, set(), [], [], []
        for part in missing:
            if part.isalpha():
                words.add(part)
            elif "\n" in part:
                lines = part.split("\n")
                if all(lines[1:]):
                    keys = [*lines[:1], *["\n" + x for x in lines[1:]]] if lines[0] else ["\n" + x for x in lines[1:]]
                    lined.append((part, keys))
                    for key in keys:
                        if key not in known:
                            if key[-1] in marks and key[-2:-1] in _LETTERS:
                                marked.append(key)
                                key = key[:-1]
                            words.add(key)
                elif lines[0]:  # line feeds that don't stand alone
                    odd.append(part)
                else:
                    known[part] = self._whole(part)
            elif not part:
                known[part] = self._whole(" ")
            elif part[-1] in marks and part[-2:-1] in _LETTERS:
                marked.append(part)
                words.add(part[:-1])
            else:
                words.add(part)
        self._encode(odd, self.blank)
        self._encode([w for w in words if w not in known], self.feed)
        for part in marked:
            known[part] = known[part[:-1]] + marks[part[-1]]
        for part, keys in lined:
            known[part] = b"".join(map(known.__getitem__, keys))
        return [*{k for made in (missing, words, marked) for k in made if len(k) > self.longest}]

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. What the texts have in long parts is forgotten afterwards."""
        known, parts = self.known, []
        for text in texts:
            if (
                not text or text[0] in " \n" or "  " in text or " \n" in text or "\n " in text or self.other_space(text)
                or any(s in text for s in self.special)
            ):
                parts.append(None)
                continue
            own = text.split(" ")
            own[0] = "\n" + own[0]  # the first has no blank: encoded after a line feed, which is cut off
            parts.append(own)
        found = set().union(*[own for own in parts if own])
        missing = found.difference(known)
        if len(known) + len(missing) > self.most:
            known.clear()
            missing = found
        long, get = self._learn(missing), known.__getitem__
        out = [b"".join(map(get, own))[4:] if own else self._whole(text) for text, own in zip(texts, parts, strict=True)]
        for key in long:
            del known[key]
        return out

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]


_encoders: dict[str, CachedEncoder] = {}


def _encoder(path: str) -> CachedEncoder:
    if path not in _encoders:
        _encoders[path] = CachedEncoder(path)
    return _encoders[path]


def tokenise(
    docs: DataFrame, capacity: int = 2048, vocabulary: str = "byte_bpe_50k.json", end_id: int = 0,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids with with_ids) of every document's token ids and end_id.

    Documents of over `capacity` ids are cut into pieces of that many, of which the first has what is left over. Null
    text counts as empty: one piece that holds end_id alone. Repeated rows each give their pieces.
    """
    fields = [
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        encode, end = _encoder(public_tokenizers.path(vocabulary)), int(end_id).to_bytes(4, "little")
        for whole in batches:
            for at in range(0, whole.num_rows, 50):
                batch = whole.slice(at, 50)
                rows, piece, start, length, crc, kept = [], [], [], [], [], []
                for row, ids in enumerate(encode.many([text or "" for text in batch.column(1).to_pylist()])):
                    ids += end
                    n, a, k = len(ids) // 4, 0, 0
                    while a < n:
                        b = a + (capacity if n == capacity or a or n % capacity == 0 else n % capacity)
                        part = ids[4 * a : 4 * b]
                        rows.append(row), piece.append(k), start.append(a), length.append(b - a), crc.append(zlib.crc32(part))
                        if with_ids:
                            kept.append(part)
                        a, k = b, k + 1
                out = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(out + [pa.array(kept, pa.binary())] * with_ids, names=[f.name for f in fields])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, T.StructType(fields))


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, longest first into the fullest bin that takes it, and the fill of each bin."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    fill: list[int] = []
    rooms = 0  # a bit for every room that some open bin has
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        if fits := rooms >> n:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += n
        if room > n:
            by_room[room - n].append(b)
            rooms |= 1 << (room - n)
    return bins, offsets, np.array(fill, np.int64)


def _left_open(fill: np.ndarray, capacity: int, nearly: int, carry: int) -> np.ndarray:
    """Which bins go on to the next round: the emptiest, of those that aren't nearly full."""
    out = np.zeros(len(fill), bool)
    emptiest = np.argsort(fill, kind="stable")[:carry]
    out[emptiest[fill[emptiest] < min(nearly, capacity)]] = True
    return out


def pack(
    pieces: DataFrame, capacity: int = 2048, per_shard: int = 16_384, fan_in: int = 8, nearly_full: float = 0.999,
) -> DataFrame:
    """pieces (at least doc_id, piece, length from 1 to capacity) with sequence_id and offset.

    Full pieces are sequences as they are. The others are dealt by their place in the table, whatever their ids, into shards of about per_shard pieces and
    packed there; each round then takes fan_in shards together with at most 2 * fan_in open bins of each. pieces is
    read several times: hand in a stored table. Repeated rows are packed one by one. No pieces give no sequences.
    """
    carry, nearly = 2 * fan_in, int(np.ceil(nearly_full * capacity))
    short = pieces.where(F.col("length") < capacity)
    shards = max(1, -(-short.count() // per_shard))
    fields = [f for f in pieces.schema.fields if f.name not in ("shard", "bin", "offset", "fill", "open")]
    names = [f.name for f in fields]
    added = "shard long, bin long, offset long, fill long, open boolean"
    schema = T.StructType(fields + T.StructType.fromDDL(added).fields)

    def first(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        bins, offsets, fill = best_fit(group.column("length").to_numpy(), capacity)
        shard = group.column("shard")[0].as_py()
        out = group.select(names)
        for name, values in (("shard", np.full(len(bins), shard)), ("bin", (np.int64(shard) << 32) + bins), ("offset", offsets), ("fill", fill[bins]), ("open", _left_open(fill, capacity, nearly, carry)[bins])):
            out = out.append_column(name, pa.array(values))
        return out

    placed = stage_table(
        short.select(*names)
        .withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(first, schema),
        "pack-placed",
    )

    def again(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["fill", "bin"], ascending=[False, True], ignore_index=True)
        bins, shift, fill = best_fit(group["fill"].to_numpy(), capacity)
        host = group["bin"].to_numpy()[np.unique(bins, return_index=True)[1]]
        return pd.DataFrame({"shard": group["shard"] // fan_in, "bin": group["bin"], "host": host[bins], "shift": shift, "fill": fill[bins], "open": _left_open(fill, capacity, nearly, carry)[bins]})

    going = placed.where("offset = 0 and open").select("shard", "bin", "fill")
    moved: DataFrame | None = None
    while shards > 1:
        done = stage_table(
            going.groupBy((F.floor(F.col("shard") / fan_in)).alias("to"))
            .applyInPandas(again, "shard long, bin long, host long, shift long, fill long, open boolean"),
            "pack-round",
        )
        step = done.where("shift > 0").select("bin", "host", "shift")
        if moved is None:
            moved = step
        else:  # what was moved before moves on with its host
            on = step.select(F.col("bin").alias("host"), F.col("host").alias("to"), F.col("shift").alias("by"))
            moved = moved.join(on, "host", "left").select("bin", F.coalesce("to", "host").alias("host"), (F.col("shift") + F.coalesce("by", F.lit(0))).alias("shift")).unionByName(step)
        going = done.where("shift = 0 and open").select("shard", "bin", "fill")
        shards = -(-shards // fan_in)
    at = placed.drop("shard", "fill", "open")
    if moved is None:
        packed = at.withColumnRenamed("bin", "sequence_id")
    else:
        packed = (
            at.join(stage_table(moved, "pack-moved"), "bin", "left")
            .withColumn("sequence_id", F.coalesce("host", "bin"))
            .withColumn("offset", F.col("offset") + F.coalesce("shift", F.lit(0)))
        )
    alone = pieces.where(F.col("length") >= capacity).select(*names).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return packed.select(*names, "sequence_id", "offset").unionByName(alone)


def pack_documents(docs: DataFrame, capacity: int = 2048, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of all documents' pieces. Only the columns doc_id
    and text are read; null text counts as empty; an empty table gives no rows."""
    return pack(stage_table(tokenise(docs, capacity, vocabulary), "pack-pieces"), capacity)
