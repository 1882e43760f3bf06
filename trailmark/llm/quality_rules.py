"""Quality rules as a short-circuit cascade.

Rules look at one text. On a bounded sample the cost of each rule and the share of texts that it rejects are estimated;
the cascade then runs the rules by rejection per cost, best first, and leaves a text at the first rule that rejects
it. A fact that one rule has asked for is free for the next. The verdict does not depend on the order, so the estimates change the time a run takes and never its result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import SPACE

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: What a line costs, and a quarter of what a word's window does, in characters.
WEIGHT = 8


class Facts:
    """What rules ask about a text; each fact is derived when first asked for, then kept.

    ``work`` adds up what the facts derived so far have cost: characters looked at, words and lines weighed as ``WEIGHT``
    of them. It depends on the text alone, so the order of a cascade is the same in every run.
    """

    def __init__(self, text: str | None):
        self.text = text or ""
        self.work = 0

    @cached_property
    def words(self) -> list[bytes]:
        self.work += len(self.text)
        return self.text.encode().split()  # bytes split at ASCII white space only

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        self.work += len(self.text)
        return len(self.text) - sum(map(self.text.count, SPACE))

    @cached_property
    def n_symbols(self) -> int:
        self.work += len(self.text)
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def n_dup_lines(self) -> int:
        self.work += len(self.text) + WEIGHT * self.text.count("\n")
        lines = [x for x in self.text.split("\n") if x.strip(SPACE)]
        return len(lines) - len(set(lines))

    @cached_property
    def n_lines(self) -> int:
        self.work += len(self.text) + WEIGHT * self.text.count("\n")
        return sum(1 for x in self.text.split("\n") if x.strip(SPACE))

    @cached_property
    def n_upper_words(self) -> int:
        self.work += WEIGHT // 4 * len(self.words)
        return sum(map(bytes.isupper, self.words))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a window of five words found twice or more, its first occurrence included."""
        self.work += 4 * WEIGHT * len(self.words)
        w = self.words
        windows = list(zip(*(w[k:] for k in range(WINDOW))))
        if len(set(windows)) == len(windows):
            return 0
        seen = Counter(windows)
        n = last = 0
        for i, x in enumerate(windows):
            if seen[x] > 1:
                n += i + WINDOW - max(i, last)
                last = i + WINDOW
        return n


@dataclass(frozen=True)
class Rule:
    """``rejects`` tells from the facts whether a text is rejected; ``params`` are its thresholds, for the record."""

    name: str
    rejects: Callable[[Facts], bool]
    params: dict = field(default_factory=dict)


#: Thresholds of the default rules.
MIN_WORDS, REPEAT_PERCENT, SYMBOL_PERCENT, DUP_LINE_PERCENT, UPPER_PERCENT, MAX_WORD = 10, 20, 10, 50, 60, 30
RULES = (
    Rule("too_short", lambda f: f.n_words < MIN_WORDS, {"min_words": MIN_WORDS}),
    Rule("repeated_words", lambda f: 100 * f.n_repeat_words > REPEAT_PERCENT * f.n_words, {"percent": REPEAT_PERCENT}),
    Rule("symbols", lambda f: 100 * f.n_symbols > SYMBOL_PERCENT * f.n_words, {"percent": SYMBOL_PERCENT}),
    Rule("duplicate_lines", lambda f: 100 * f.n_dup_lines > DUP_LINE_PERCENT * f.n_lines, {"percent": DUP_LINE_PERCENT}),
    Rule("upper_case", lambda f: 100 * f.n_upper_words > UPPER_PERCENT * f.n_words, {"percent": UPPER_PERCENT}),
    Rule("long_words", lambda f: f.word_chars > MAX_WORD * f.n_words, {"mean_length": MAX_WORD}),
)
#: The rules that the base verdict is made of.
BASE = ("too_short", "repeated_words")


def estimate(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample: int = 2000) -> list[dict]:
    """Cost (in characters, see ``Facts.work``) and rejected share of each rule on about ``sample`` random texts, in the cascade's order.

    The texts are looked at where they lie; only sums come back. Costs are those of fresh facts, as a rule pays for
    the facts that it is the first to ask for. With an empty table all costs and shares are 0 and the given order holds.
    """
    picked = docs.select(F.col(text_col).cast("string").alias("text")).sample(min(1.0, sample / max(1, docs.count())), seed=7)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [[at, 0, 0, 0] for at in range(len(rules))]
        for b in batches:
            for text in b.column(0).to_pylist():
                for s, rule in zip(sums, rules):
                    of = Facts(text)
                    s[2] += rule.rejects(of)
                    s[1] += of.work
                    s[3] += 1
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*sums), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["at", "cost", "rejected", "n"])

    sums = picked.mapInArrow(run, "at int, cost long, rejected long, n long").groupBy("at").agg(F.sum("cost").alias("cost"), F.sum("rejected").alias("rejected"), F.sum("n").alias("n"))
    found = {r.at: r for r in sums.collect()}
    out = []
    for at, rule in enumerate(rules):
        cost, rejected, n = (found[at].cost, found[at].rejected, max(1, found[at].n)) if at in found else (0, 0, 1)
        out.append({"rule": rule.name, "cost": cost / n, "rejected": rejected / n, "at": at})
    return sorted(out, key=lambda x: (-x["rejected"] / max(x["cost"], 1e-9), x["at"]))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample: int = 2000, facts: bool = False) -> DataFrame:
    """(id, kept, rejected_by) for every row; with ``facts`` also n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    ``rejected_by`` is the first rule of the cascade that rejects the text (null where kept); as the order follows a
    sample, it can name another of the rejecting rules where files are laid out anew, ``kept`` can't. A null text has no
    words. Repeated rows are judged alike; other columns are ignored; an empty table stays empty.
    """
    by_name = {r.name: r for r in rules}
    order = [by_name[x["rule"]] for x in estimate(docs, text_col, rules, sample)]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"] if facts else []
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("kept", T.BooleanType()), T.StructField("rejected_by", T.StringType()),
        *(T.StructField(n, T.LongType()) for n in names),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by, values = [], [[] for _ in names]
            for t in b.column(1):
                of = Facts(t.as_py())
                by.append(next((r.name for r in order if r.rejects(of)), None))
                for n, v in zip(names, values):
                    v.append(getattr(of, n))
            columns = [b.column(0), pa.array([x is None for x in by]), pa.array(by, pa.string()), *(pa.array(v, pa.int64()) for v in values)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def keep(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample: int = 2000) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns, whatever their names.

    Null and empty texts have no words and are judged so; repeated rows, null and repeated ids are judged alike. An empty
    table stays empty.
    """
    by_name = {r.name: r for r in rules}
    order = [by_name[x["rule"]] for x in estimate(docs, text_col, rules, sample)]
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = []
            for t in b.column(at):
                of = Facts(t.as_py())
                kept.append(not any(r.rejects(of) for r in order))
            yield b.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
