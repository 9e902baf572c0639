"""Tables with everything odd: nulls, empty and very long texts, repeated rows, ties, columns with clashing names."""

from __future__ import annotations

import random

CLASHING = "kept data th packed spans fp component_id shard bin offset fill open mix_size mix_source mix_copies mix_target place score predicted bits accepted lang_pred n_words base_failed license known_sentences n_bytes gone identity read_id".split()


def words(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefghijklmno", k=r.randint(1, 9))) for _ in range(n))


def rows() -> list[tuple]:
    long = words(60_000, 1)
    text = [None, "", " \n\t ", "a", "Ü", "x y", words(80, 2), words(80, 2), words(300, 3), words(300, 3) + " more", long, "!" * 300, "ab" * 400, "A b " * 200, "a  b　c <|endoftext|> d"]
    out = [(i, t, ("en", "de", None)[i % 3], ("s1", "s0", None)[i % 3], len(t) if t else None) for i, t in enumerate(text)]
    return out + [(6, words(80, 2), "en", "s1", 1), (7, words(90, 9), "de", "s0", 1), (None, words(80, 2), "en", "s1", 1), (None, None, None, None, None)]


def documents(spark, extra: bool = True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return df.withColumns({c: F.lit(f"old {c}") for c in CLASHING}) if extra else df


def empty(spark):
    return documents(spark).where("false")
