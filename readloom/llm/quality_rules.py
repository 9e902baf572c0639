"""Quality rules as a short-circuit cascade.

Each rule's cost and rejections are measured on a sample, all rules on every sampled text; the cascade then asks the
rules in the order of rejections per cost and stops at the first that rejects. The order changes what the cascade
costs, never its verdict.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from time import perf_counter_ns

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD

_words = re.compile(WORD).findall
_upper, _ascii_letters = re.compile("[A-Z]+").findall, re.compile("[A-Za-z]+").findall
_has_letter = re.compile(r"[A-Za-z]|[^\x00-\x7F]").search
SYMBOLS = "#*$%&|<>"
_BLANK = " \t\n\x0b\x0c\r"


class Measured:
    """A text with measures that are taken when first asked for. Null text counts as empty."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[str]:
        return _words(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if x.strip(_BLANK)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows of three that are found twice or more."""
        n = self.n_words - 2
        if n < 2:
            return 0
        ids: dict[str, int] = {}
        a = np.array([ids.setdefault(w, len(ids)) for w in self.words], np.int64)
        pairs, many = a[:-2] * len(ids) + a[1:-1], len(ids)
        if many > 2_000_000:  # or the cube leaves 64 bits
            pairs = np.unique(pairs, return_inverse=True)[1]
        windows = pairs * many + a[2:]
        order = np.argsort(windows, kind="stable")
        equal = windows[order[1:]] == windows[order[:-1]]
        if not equal.any():
            return 0
        covered = np.zeros(n + 2, bool)
        starts = np.concatenate([order[1:][equal], order[:-1][equal]])
        for k in range(3):
            covered[starts + k] = True
        return int(covered.sum())

    @cached_property
    def upper_share(self) -> float:
        letters = sum(map(len, _ascii_letters(self.text)))
        return sum(map(len, _upper(self.text))) / letters if letters else 0.0

    @cached_property
    def letter_word_share(self) -> float:
        return sum(1 for w in self.words if _has_letter(w)) / self.n_words if self.words else 0.0

    @cached_property
    def base_failed(self) -> bool:
        return self.n_words < 50 or 100 * self.n_repeat_words > 50 * self.n_words


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measured], bool]


#: Production rules. A text without words has no mean length and no symbols a word; those rules let it pass.
RULES = (
    Rule("word_length", lambda m: m.n_words > 0 and not 2 * m.n_words <= m.word_chars <= 12 * m.n_words),
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("repeated_lines", lambda m: 2 * m.n_dup_lines > len(m.lines)),
    Rule("capitals", lambda m: m.upper_share > 0.5),
    Rule("letter_words", lambda m: m.n_words > 0 and m.letter_word_share < 0.6),
)


def rule_order(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = 2000, seed: int = 7, text_col: str = "text") -> list[str]:
    """Names of rules in the order of rejections per nanosecond, on a sample of about sample_rows rows.

    As in the cascade, rules are asked about texts that pass the base, with the base's measures taken, and a rule counts
    what the rules before it let pass: the best comes first, then the best of what is left of the sample. Rules that
    reject nothing more come last, cheapest first. No text that passes the base leaves the order given.
    """
    rows = docs.count()
    sample = docs.select(text_col).sample(min(1.0, sample_rows / max(rows, 1)), seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rejected, cost = [], []
        for batch in batches:
            for text in batch.column(0):
                m = Measured(text.as_py())
                if m.base_failed:
                    continue
                said, took = [], []
                for r in rules:
                    began = perf_counter_ns()
                    said.append(bool(r.rejects(m)))
                    took.append(perf_counter_ns() - began)
                rejected.append(said)
                cost.append(took)
        yield pa.RecordBatch.from_arrays([pa.array(rejected, pa.list_(pa.bool_())), pa.array(cost, pa.list_(pa.int64()))], names=["rejected", "cost"])

    found = sample.mapInArrow(run, "rejected array<boolean>, cost array<long>").collect()  # about sample_rows rows
    left = list(range(len(rules)))
    if not found:
        return [r.name for r in rules]
    cost = [max(1, sum(row["cost"][i] for row in found)) / len(found) for i in left]
    order = []
    while left:
        gains = {i: sum(row["rejected"][i] for row in found) / cost[i] for i in left}
        best = min(left, key=lambda i: (-gains[i], cost[i]))
        order.append(rules[best].name)
        left.remove(best)
        found = [row for row in found if not row["rejected"][best]]
    return order


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, order: Sequence[str] | None = None, text_col: str = "text", measures: Sequence[str] = ()) -> DataFrame:
    """docs without text_col, and base_failed, kept, rejected_by (null if kept or if the base failed), and measures.

    kept is false if the base failed, which the rules aren't asked about, or if any rule rejects. Null text counts as
    empty and fails the base; repeated rows are judged alike; other columns pass through, and those of the names
    above are replaced; an empty table gives an empty table.
    """
    by_name = {r.name: r for r in rules}
    asked = [by_name[n] for n in (rule_order(docs, rules, text_col=text_col) if order is None else order)]
    made = [*measures, "base_failed", "kept", "rejected_by"]
    rest = [c for c in docs.columns if c not in (*made, text_col)]
    fields = [docs.schema[c] for c in rest] + [T.StructField(m, T.LongType()) for m in measures]
    schema = T.StructType(fields + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("rejected_by", T.StringType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(len(rest)):
                m = Measured(text.as_py())
                by = None if m.base_failed else next((r.name for r in asked if r.rejects(m)), None)
                out.append((*[getattr(m, x) for x in measures], m.base_failed, not m.base_failed and by is None, by))
            columns = list(zip(*out, strict=True)) or [()] * (len(measures) + 3)
            kinds = [pa.int64()] * len(measures) + [pa.bool_(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=names)

    return docs.select(*rest, text_col).mapInArrow(run, schema)
