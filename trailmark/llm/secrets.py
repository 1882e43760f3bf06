"""Secret scan by assignment-aware lexing.

A text is cut into tokens (strings of every kind, words, operators, brackets, line ends) and read as source code and
configuration at once: ``name = value``, ``name: value``, ``name: type = value``, ``"name" => value``, values in calls,
lists and nested blocks, on the next line, in YAML blocks, XML elements and attributes, and assignments inside strings.
A value is a chain of literals and names. Constants propagate over the whole text, wherever they are defined: a name
that stands as a value passes the sensitivity of its target on to its own literals, at any distance. Each literal is
scored by the most sensitive name that it reaches and by how random it looks; literals at ``threshold`` or more are
reported with the kind ``lexed``. Three fixed forms (keyword assignments, access key ids, long hex runs) are always
reported.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Order in which kinds are listed at one start.
KINDS = ("assign", "access", "hex", "lexed")
ASSIGN = re.compile(r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs are maximal, so this is [0-9a-f]+ without the shorter runs
#: A text without any of these (in lower case) has no assign match.
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Sensitivity of the parts of a name.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "private": 0.6, "auth": 0.6, "bearer": 0.7, "access": 0.5, "key": 0.6,
    "signature": 0.5, "session": 0.4, "dsn": 0.4, "cookie": 0.4, "salt": 0.4,
}
#: Literals that stand for a value without being one.
PLACEHOLDERS = {"true", "false", "none", "null", "changeme", "example", "password", "secret", "token", "undefined", "redacted", "xxxxxxxx"}

#: A text without any of these (in lower case) has no name above zero.
_ANY_SENSITIVE = [w for w in SENSITIVE if not any(v in w for v in SENSITIVE if v != w)]
#: Words that open a block or a declaration.
BLOCKS = {"class", "def", "if", "elif", "else", "while", "for", "try", "except", "finally", "with", "case", "switch", "default", "lambda", "return", "match"}
DECLARES = {"var", "const", "dim", "let", "val"}
#: What a name in an enclosing block counts for, against a name of the literal's own.
ENCLOSING = 0.8
_DIGITS, _LETTERS = set("0123456789"), set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_TOKEN = re.compile(
    r"""(?P<line>\n)|(?P<blank>[^\S\n]++|\\\r?\n)|(?P<escape>\\.)
    |(?:(?<![\w$])[rRbBuUfFLN@$]{0,2}(?:\"\"\"(?P<d3>(?:[^\\"]|\\.|"(?!""))*+)\"\"\"|'''(?P<s3>(?:[^\\']|\\.|'(?!''))*+)'''
        |"(?P<d>(?:[^"\\\n]|\\.)*+)"|'(?P<s>(?:[^'\\\n]|\\.)*+)'|`(?P<b>(?:[^`\\]|\\.)*+)`))
    |(?P<word>[\w$]++(?:[.-][\w$]++)*+)|(?P<other>===?|!==?|<=|>=|::|->|:(?=//))|(?P<assign>:=|=>|(?:\?\?|\|\||[+?.|&])?=|:)
    |(?P<plus>\+|\|\||\?\?|\.(?!\.))|(?P<open>[(\[{])|(?P<close>[)\]}])|(?P<comma>,)|(?P<end>;)|(?P<mark>.)""",
    re.VERBOSE | re.DOTALL,
)
_BARE = re.compile(r"[^\s\"'`,;(){}\[\]<>|\\]++")
_KEY = re.compile(r"[\w$./ -]++")
_KEY_ENDS = re.compile(r":(?:\s|$)")
_TYPE_ENDS = re.compile(r"""=(?:[ \t]++[^\s=]|["'`])""")
_GOES_ON = re.compile(r"[ \t]*+[+.]")
_BLOCK = re.compile(r"[ \t]*+[|>][0-9+-]*+[ \t]*+\r?\n")
_ELEMENT = re.compile(r"<([A-Za-z_][\w.:-]*+)((?:\s[^<>]*+)?)>(?:\s*+<!\[CDATA\[((?:[^\]<]|\](?!\]>)|<(?!!\[CDATA\[))*+)\]\]>\s*+|([^<]*+))</", re.DOTALL)
_TAG = re.compile(r"<[A-Za-z_][\w.:-]*+(\s[^<>]*+)>", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([\w.:-]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)')""")
_STRINGS = ("d3", "s3", "d", "s", "b")


class Span(NamedTuple):
    start: int
    end: int
    kind: str
    score: float


def sensitivity(name: str) -> float:
    """0 to 1: the most sensitive part of a name; ``api`` before ``key`` counts as ``apikey``."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    pairs = [a + b for a, b in zip(parts, parts[1:])]
    return max((SENSITIVE.get(p.rstrip("s") if p not in SENSITIVE else p, 0.0) for p in parts + pairs), default=0.0)


def randomness(value: str) -> float:
    """0 to 1: Shannon entropy of the characters against that of 32 equally frequent ones, less for short values."""
    n = len(value)
    if n < 8 or value.lower() in PLACEHOLDERS:
        return 0.0
    counts = Counter(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    mixed = 1.0 if counts.keys() & _DIGITS and counts.keys() & _LETTERS else 0.5
    return min(1.0, entropy / min(5.0, math.log2(n))) * mixed * min(1.0, n / 16)


class Assignment:
    """What is assigned to names: spans of literals, and words with their spans, which are literals unless they name a constant."""

    __slots__ = ("names", "parent", "column", "typed", "literals", "words", "level")

    def __init__(self, names: list[str], parent: Assignment | None = None, column: int = 0, typed: bool = False):
        self.names, self.parent, self.column = [n.lstrip("$") for n in names], parent, column
        self.typed = typed  # stands after a colon, with nothing but words so far: they may be a type
        self.literals: list[tuple[int, int]] = []
        self.words: list[tuple[str, int, int]] = []
        self.level = 0.0

    def forget(self, start: int) -> None:
        """Take back what turns out to be the name of a nested assignment."""
        if self.literals and self.literals[-1][0] >= start:
            self.literals.pop()
        elif self.words and self.words[-1][1] >= start:
            self.words.pop()


def _names(before: list[tuple[str, int, str]], colon: bool) -> list[str]:
    """The names that the words and strings before an operator stand for; none for what opens a block of code."""
    if not before:
        return []
    kind, _, last = before[-1]
    if kind == "string":
        return [last] if _KEY.fullmatch(last) else []
    first = before[0][2].lower()
    if colon and first in BLOCKS:
        return []
    return [last, before[1][2]] if first in DECLARES and len(before) > 2 else [last]


def _lex_tokens(text: str, start: int, past: int) -> tuple[list[Assignment], list[tuple[int, int]]]:
    """The assignments that the tokens of text[start:past] make up, and the insides of its strings."""
    found: list[Assignment] = []
    strings: list[tuple[int, int]] = []
    stack: list[tuple[str, Assignment | None]] = []  # open brackets, and what goes on after them
    blocks: list[Assignment] = []  # those that the present row is further in than
    now: Assignment | None = None
    fresh = choice = False  # whether a value is due; whether a colon parts two values
    before: list[tuple[str, int, str]] = []  # words and strings since the last other token of the row: kind, start, content
    row, column, empty, last = start, 0, True, ""
    at = start
    while at < past:
        m = _TOKEN.match(text, at, past)
        kind, begin, at = m.lastgroup, m.start(), m.end()
        if kind in ("blank", "escape"):
            continue
        if kind == "line":
            if empty:  # an empty row ends all
                stack, blocks, now, fresh = [], [], None, False
            elif now and not fresh and (not stack or stack[-1][0] == "{") and not _GOES_ON.match(text, at, past):
                now = None
            row, empty, before, last = at, True, [], kind
            continue
        if empty:
            empty, column = False, begin - row
            while blocks and blocks[-1].column >= column:
                blocks.pop()
            if now and fresh and not stack:
                if column > now.column:
                    blocks.append(now)
                else:
                    now = None
        if fresh and now and kind == "word" and now.typed and _TYPE_ENDS.match(text, at, past):
            now.words.append((m[0], begin, at))
            last = kind
            continue
        key = kind == "word" and _KEY_ENDS.match(text, at, past)
        if fresh and now and not key and kind in ("word", "mark", "other", "plus", "assign") and (bare := _BARE.match(text, begin, past)):
            z = bare.end()
            if kind == "word" or z - begin > 1:
                if kind == "word" and z == at:
                    now.words.append((m[0].lstrip("$"), begin, z))
                else:
                    now.literals.append((begin, z))
                before.append(("word", begin, text[begin:z]))
                last, fresh, at = "word", False, z
            continue
        if kind in _STRINGS:
            a, z = m.span(kind)
            strings.append((a, z))
            before.append(("string", a, text[a:z]))
            if now:
                if z > a:
                    now.literals.append((a, z))
                fresh = now.typed = False
        elif kind == "word":
            before.append(("word", begin, m[0]))
            fresh = now is not None and (fresh or m[0] in ("or", "and", "if", "else"))
        elif kind == "assign" and m[0] == ":" and choice and now:
            fresh, choice, before = True, False, []
        elif kind == "assign":
            if m[0] == "=" and now and now.typed and now.words:  # name: type = value
                now.words, now.typed, fresh = [], False, True
            elif names := _names(before, m[0] == ":"):
                if now:
                    now.forget(before[-1][1])
                around = stack[-1][1] if stack else blocks[-1] if blocks else None
                now, fresh = Assignment(names, around, column, m[0] == ":"), True
                found.append(now)
                if m[0] == ":" and not stack and (block := _BLOCK.match(text, at, past)):  # YAML: all rows further in
                    at = block.end()
                    while at < past:
                        stop = text.find("\n", at, past) + 1 or past
                        if (line := text[at:stop]).strip() and len(line) - len(line.lstrip()) <= column:
                            break
                        now.literals += [x.span() for x in _BARE.finditer(text, at, stop)]
                        at = stop
                    row, empty, now, fresh = at, True, None, False
            elif not stack:
                now, fresh = None, False
            before = []
        elif kind == "open":
            if m[0] == "[" and last in ("word", "close") and not fresh:  # an index: it may name what is assigned
                stack.append(("index", now))
                now = None
            else:
                if now and now.words and now.words[-1][2] == begin:  # the name of a call
                    now.words.pop()
                stack.append((m[0], now))
                fresh, before = now is not None, []
        elif kind == "close":
            if stack:
                was, now = stack.pop()
                before = before if was == "index" else []
            fresh = False
        elif kind == "comma":
            if stack and stack[-1][0] != "index":
                now = stack[-1][1]
                if stack[-1][0] == "(" and [x[0] for x in before] == ["string"] and sensitivity(before[0][2]):  # set("name", "value")
                    now = Assignment([before[0][2]], now, column)
                    found.append(now)
                fresh = now is not None
            elif not stack:
                now, fresh = None, False
            before = []
        elif kind == "end":
            now, fresh, before = None, False, []
        elif kind == "plus":
            fresh, before = now is not None, []
        elif m[0] not in "*&?!@":
            before = []
        choice = kind not in ("line", "comma", "end") and (choice or m[0] == "?" and text[at : at + 1] != ":")
        last = kind
    return found, strings


def _lex_markup(text: str, start: int, past: int) -> list[Assignment]:
    """Elements with a text, named by their tag and by an attribute key, name or id; attributes value beside such a name."""
    found = []
    named = lambda pairs: [text[slice(*at)] for name, at in pairs if name in ("key", "name", "id")]
    attributes = lambda a, z: [(x[1].lower(), x.span(2 if x[2] is not None else 3)) for x in _ATTRIBUTE.finditer(text, a, z)]
    for m in _ELEMENT.finditer(text, start, past):
        a, z = m.span(3 if m[3] is not None else 4)
        found.append(Assignment([m[1], *named(attributes(*m.span(2)))]))
        if text[a:z].strip():
            found[-1].literals.append((z - len(text[a:z].lstrip()), a + len(text[a:z].rstrip())))
    for m in _TAG.finditer(text, start, past):
        pairs = attributes(*m.span(1))
        if names := named(pairs):
            found.append(Assignment(names))
            found[-1].literals += [at for name, at in pairs if name in ("value", "content", "default") and at[1] > at[0]]
    return found


def lex(text: str) -> list[Assignment]:
    """The assignments of a text, those inside its strings (connection strings, queries, embedded files) included."""
    found, todo = [], [(0, len(text))]
    while todo:
        part = todo.pop()
        own, strings = _lex_tokens(text, *part)
        found += own + (_lex_markup(text, *part) if text.find("<", *part) >= 0 else [])
        todo += [s for s in strings if s != part and (text.find("=", *s) >= 0 or text.find(":", *s) >= 0)]
    return found


def literals(text: str) -> dict[tuple[int, int], float]:
    """For each literal of the text's assignments the sensitivity of the most sensitive name that it reaches."""
    every = lex(text)
    defined: dict[str, list[Assignment]] = {}
    for x in every:
        x.level = max(map(sensitivity, x.names))
        if x.parent:  # an enclosing block, which stands before
            x.level = max(x.level, ENCLOSING * x.parent.level)
        for name in x.names:
            defined.setdefault(name, []).append(x)
    passed: dict[str, float] = {}  # the level that users of a name have passed on to it
    number = itertools.count()
    todo = [(-x.level, next(number), x) for x in every if x.level]
    heapq.heapify(todo)
    while todo:
        level, _, x = heapq.heappop(todo)
        for word, _, _ in x.words if -level == x.level else ():
            if passed.get(word, 0.0) < x.level:
                passed[word] = x.level
                for y in defined.get(word, ()):
                    if y.level < x.level:
                        y.level = x.level
                        heapq.heappush(todo, (-y.level, next(number), y))
    out: dict[tuple[int, int], float] = {}
    for x in every:
        for span in [*x.literals, *((a, z) for w, a, z in x.words if w not in defined)]:
            out[span] = max(out.get(span, 0.0), x.level)
    return out


def scan(text: str | None, threshold: float = 0.6) -> list[Span]:
    """All spans (code points, end exclusive) by start, then kind as in ``KINDS``; equal spans of one kind once."""
    text = text or ""
    spans = set()
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        spans |= {Span(*m.span(), "assign", 1.0) for m in ASSIGN.finditer(text) if len(m[1]) >= 8}
    if "AKIA" in text:
        spans |= {Span(*m.span(), "access", 1.0) for m in ACCESS.finditer(text) if len(m[0]) >= 16}
    spans |= {Span(*m.span(), "hex", 1.0) for m in HEX.finditer(text)}
    if ("=" in text or ":" in text or "</" in text or "(" in text) and any(w in lower for w in _ANY_SENSITIVE):
        for (a, z), level in literals(text).items():
            if level >= threshold and (score := level * randomness(text[a:z])) >= threshold:
                spans.add(Span(a, z, "lexed", round(score, 4)))
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.6) -> DataFrame:
    """(id, spans: array of kind, start, end, score) for every row; null and empty texts have no spans.

    Rows are independent: repeated rows give repeated results, other columns are ignored, an empty table stays empty.
    """
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("spans", T.ArrayType(span))])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[s._asdict() for s in scan(t.as_py(), threshold)] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, arrow)], names=["id", "spans"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.6, mark: str = "<SECRET>") -> DataFrame:
    """``docs`` with each run of overlapping spans of ``text_col`` replaced by ``mark``.

    Null texts stay null and empty ones empty. Rows are independent of each other: repeated rows and ids, null ids among
    them, come out as often; all other columns are carried as they are, whatever their names. An empty table stays empty.
    """
    at = docs.columns.index(text_col)
    plain = docs.schema[text_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for t in b.column(at):
                if (text := t.as_py()) is not None and (spans := scan(text, threshold)):
                    out, last = [], 0
                    for s in spans:
                        if s.start >= last:
                            out += [text[last : s.start], mark]
                        last = max(last, s.end)
                    text = "".join([*out, text[last:]])
                texts.append(text)
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))

    return docs.withColumn(text_col, F.col(text_col).cast(plain)).mapInArrow(run, docs.schema)


def digest(spans: DataFrame) -> DataFrame:
    """The digest columns of ``find_secrets``: counts of the base kinds, SHA-256 of the base spans, all spans as text."""
    listed = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "lexed")
    return spans.select(
        F.col("id").alias("doc_id"), of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )


def digest_of(text: str | None, threshold: float = 0.6) -> tuple[str, str]:
    """(base_sha256, spans) of one text, as ``digest`` gives them."""
    spans = scan(text, threshold)
    listed = [f"{s.kind}:{s.start}:{s.end}" for s in spans]
    return hashlib.sha256(",".join(x for x in listed if not x.startswith("lexed")).encode()).hexdigest(), ",".join(listed)
