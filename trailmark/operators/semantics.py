"""Business meaning of events from a taxonomy of phrases: texts read by an automaton, slots filled by rank, joined back."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vocabulary

UNKNOWN, GENERAL = "unknown", "general"
MOST_PHRASES = 100_000
COLUMNS = ("business_family", "business_module", "business_object", "operation", "operation_stage", "semantic_confidence", "semantic_evidence")
#: What each resolved part of a label adds to its confidence.
WEIGHTS = {
    "family_strong": 0.40, "family_weak": 0.20, "family_inherited": 0.15, "module_specific": 0.20, "module_general": 0.05, "module_inherited": 0.08,
    "object_matched": 0.15, "object_inherited": 0.07, "operation_matched": 0.25, "operation_default": 0.10,
}
#: Words of a name (acronyms stay whole), units led by a digit, a suffix of view classes.
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z][a-z0-9]*|[a-z][a-z0-9]*|[0-9]+")
_UNIT = re.compile(r"\d+[A-Za-z]+")
_SUFFIX = re.compile(r"(?<=[A-Za-z])VC$")
#: Parts of a path that identify an instance: masks, numbers, hexadecimal ids, versions, words for nothing.
DYNAMIC = (r"\{[a-z]+\}", r"-?\d+", r"(?i:[0-9a-f]{8,})", r"(?i:v\d+)", r"(?i:null|none|nil|undefined|nan)")
_DYNAMIC = re.compile("|".join(DYNAMIC))
#: The stage of each operation.
STAGES = {
    "open": "entry", "view": "entry", "list": "browse", "select": "browse", "search": "browse", "filter": "browse", "refresh": "browse", "create": "configure", "update": "configure",
    "rename": "configure", "schedule": "configure", "enable": "configure", "disable": "configure", "toggle": "configure", "confirm": "commit", "submit": "commit", "pay": "commit",
    "delete": "commit", "block": "commit", "unblock": "commit", "restart": "commit", "login": "commit", "logout": "commit", "share": "commit", "scan": "commit", "download": "commit",
    "rate": "commit", "back": "abort", "close": "abort", "cancel": "abort",
}
#: Tiers of sections, the first that has a match wins.
SECTIONS = ("strong", "weak", "fallback")
#: Columns of tokens by the level that models name, and by the channel that features name.
LEVELS = {"EXACT": "event_token", "L3": "token_l3", "L2": "token_l2", "L1": "token_l1"}
CHANNELS = {"intent": "token_l3", "coarse": "token_l2", "family": "token_l1", "operation": "token_operation"}

Phrase = tuple[str, ...]


@dataclass(frozen=True)
class Taxonomy:
    """Phrases (words joined by spaces) and what they mean; sections are tried tier by tier.

    ``strong``, ``weak`` and ``fallback``: phrase -> (family, module). ``aliases``: phrase -> phrase. ``infrastructure``:
    words without meaning. ``generic``: phrases of gestures, which take their screen's meaning. ``stages``: operation -> stage.
    """

    strong: Mapping[str, tuple[str, str]]
    weak: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    fallback: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    objects: Mapping[str, str] = field(default_factory=dict)
    operations: Mapping[str, str] = field(default_factory=dict)
    stages: Mapping[str, str] = field(default_factory=dict)
    aliases: Mapping[str, str] = field(default_factory=dict)
    infrastructure: frozenset[str] = frozenset()
    generic: frozenset[str] = frozenset()

    @staticmethod
    def from_rows(rows: DataFrame) -> Taxonomy:
        """A taxonomy from a table (section, phrase, value, module), a few thousand rows at most; ValueError with its ``problems``.

        Sections are strong, weak and fallback (value: family), object, operation, stage (phrase: operation), alias,
        infrastructure and generic (no value). Underscores in phrases stand for spaces. Stages default to ``STAGES``.
        """
        held: dict[str, dict[str, tuple]] = {}
        repeated = []
        for r in rows.select("section", "phrase", "value", "module").limit(MOST_PHRASES + 1).collect():
            phrase, of = (r["phrase"] or "").replace("_", " "), held.setdefault(r["section"], {})
            if phrase in of:
                repeated.append(f"{r['section']} phrase twice: {phrase!r}")
            of[phrase] = (r["value"], r["module"] or GENERAL)
        if sum(map(len, held.values())) > MOST_PHRASES:
            raise ValueError(f"a taxonomy of more than {MOST_PHRASES} phrases")
        pairs, first = lambda s: held.get(s, {}), lambda s: {k: v[0] for k, v in held.get(s, {}).items()}
        out = Taxonomy(
            pairs("strong"), pairs("weak"), pairs("fallback"), first("object"), first("operation"), first("stage") or STAGES, {k: (v or "").replace("_", " ") for k, v in first("alias").items()},
            frozenset(pairs("infrastructure")), frozenset(pairs("generic")),
        )
        if wrong := repeated + out.problems():
            raise ValueError("; ".join(wrong))
        return out

    def problems(self) -> list[str]:
        """What is wrong with the tables: meaningless words in phrases, aliases of aliases or of themselves, phrases in two tiers, operations without a stage."""
        out = [f"alias of itself: {a!r}" for a, b in self.aliases.items() if a == b]
        out += [f"infrastructure word in {a!r}" for a in self.generic if set(a.split()) & self.infrastructure]
        out += [f"infrastructure word in {p!r}" for t in (self.strong, self.weak, self.fallback, self.objects) for p in t if set(p.split()) & self.infrastructure]
        out += [f"alias of an alias: {a!r}" for a, b in self.aliases.items() if b in self.aliases and a != b]
        out += [f"in two tiers: {p!r}" for a, b in ((self.strong, self.weak), (self.strong, self.fallback), (self.weak, self.fallback)) for p in set(a) & set(b)]
        return out + [f"no stage: {o!r}" for o in sorted(set(self.operations.values()) - set(self.stages))]


class Matcher:
    """A taxonomy made ready to read paths: words, and all phrases in them by one automaton over words.

    The automaton is a trie of all phrases with links from each node to its longest proper suffix in the trie and to the
    nearest one that ends a phrase. Reading takes time in proportion to words and matches, whatever the number of phrases.
    """

    def __init__(self, taxonomy: Taxonomy) -> None:
        self.taxonomy = taxonomy
        self.longest = max((a.count(" ") + 1 for a in taxonomy.aliases), default=0)
        entries = [(tier, p, *v) for tier in SECTIONS for p, v in getattr(taxonomy, tier).items()]
        entries += [(slot, p, v, None) for slot in ("objects", "operations") for p, v in getattr(taxonomy, slot).items()]
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple]] = [[]]
        for slot, phrase, value, module in entries:
            node = 0
            for word in phrase.split():
                if word not in self.next[node]:
                    self.next[node][word] = len(self.next)
                    self.next.append({})
                    self.ends.append([])
                node = self.next[node][word]
            self.ends[node].append((slot, value, module, phrase, phrase.count(" ") + 1))
        self.suffix, self.output = [0] * len(self.next), [0] * len(self.next)
        queue = list(self.next[0].values())
        for node in queue:  # breadth first: the list grows while it is read
            for word, child in self.next[node].items():
                self.suffix[child] = self._step(self.suffix[node], word)
                queue.append(child)
            up = self.suffix[node]
            self.output[node] = up if self.ends[up] else self.output[up]

    def _step(self, node: int, word: str) -> int:
        while node and word not in self.next[node]:
            node = self.suffix[node]
        return self.next[node].get(word, 0)

    def words(self, path: str | None) -> Phrase:
        text = (path or "").strip()
        if not text or text.lower() in {"nan", "none", "null", "nat"} or text.startswith("<") and text.endswith(">"):
            return ()
        plain = [part for segment in re.split(r"[/\\]+", re.split(r"[?#]", text)[0]) if not _DYNAMIC.fullmatch(segment) for part in re.split(r"[^0-9A-Za-z]+", segment)]
        cased = (w for part in plain if part and not _DYNAMIC.fullmatch(part) for w in ([part] if _UNIT.fullmatch(part) else _WORD.findall(_SUFFIX.sub("", part))))
        return self._named([w.lower() for w in cased if not _DYNAMIC.fullmatch(w)])

    def _named(self, words: list[str]) -> Phrase:
        """Aliases replaced, the longest first from the left, and words without meaning left out."""
        aliases, out, at = self.taxonomy.aliases, [], 0
        while at < len(words):
            sizes = range(min(self.longest, len(words) - at), 0, -1)
            size = next((n for n in sizes if " ".join(words[at : at + n]) in aliases), 0)
            out += aliases[" ".join(words[at : at + size])].split() if size else words[at : at + 1]
            at += max(1, size)
        return tuple(w for w in out if w not in self.taxonomy.infrastructure)

    def hits(self, words: Phrase) -> list[tuple]:
        """(slot, value, module, phrase, length, end) for each phrase wherever it stands."""
        node, out = 0, []
        for end, word in enumerate(words, 1):
            node = at = self._step(node, word)
            while at:
                out += [(*e, end) for e in self.ends[at]]
                at = self.output[at]
        return out


def words_of(path: str | None, taxonomy: Taxonomy) -> Phrase:
    """The words of a path that mean something, however it is written: slashes, snake case, camel case, queries, ids."""
    return Matcher(taxonomy).words(path)


_HIT = "struct<slot:string,value:string,module:string,phrase:string,length:int,end:int>"


def resolved(texts: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """(text, section, object, operation, generic, bare) for the distinct ``texts`` (text): each slot by the rank of its matches.

    A section's tier comes first, then whether it names a module; then, as for objects and operations, the phrase that
    ends last, and the longest of those. ``generic``: a gesture; ``bare``: no words but operations.
    """

    @F.pandas_udf(f"hits array<{_HIT}>, generic boolean, bare boolean")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(taxonomy)
        for column in batches:
            words = column.map(matcher.words)
            one = lambda ws: all(w in taxonomy.operations for w in ws)
            yield pd.DataFrame({"hits": words.map(matcher.hits), "generic": words.map(lambda ws: " ".join(ws) in taxonomy.generic), "bare": words.map(one)})

    def best(slots: tuple[str, ...], *first: Callable[[Column], Column]) -> Column:
        mine = F.filter("hits", lambda h: h["slot"].isin(*slots))
        ranked = F.transform(mine, lambda h: F.struct(*(f(h).alias(f"r{i}") for i, f in enumerate(first)), h["end"].alias("end"), h["length"].alias("length"), h.alias("hit")))
        return F.array_max(ranked)["hit"]

    tier = lambda h: F.array_position(F.array(*map(F.lit, reversed(SECTIONS))), h["slot"])
    section = best(SECTIONS, tier, lambda h: h["module"] != GENERAL)
    out = texts.select("text", read("text").alias("r")).select("text", "r.*")
    return out.select("text", section.alias("section"), best(("objects",)).alias("object"), best(("operations",)).alias("operation"), "generic", "bare")


def annotate(events: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """``events`` with the label columns. Each distinct text is read once, each distinct (event_type, screen_context, segment_name) labelled once.

    A view speaks by its screen, anything else by its target. Family and module of an action are its target's, or else,
    and always for a gesture, its screen's; so is the object. What speaks fills slots with a weight and a source each;
    confidence is the sum of the weights, evidence the list of the slots. Without a family nothing is known.
    """
    keys = ["event_type", "screen_context", "segment_name"]
    view, screen = F.col("event_type") == "view", F.coalesce("screen_context", F.lit(""))
    target = F.when(view, "").otherwise(F.coalesce("segment_name", F.lit("")))
    asked = events.select(*keys).distinct().withColumns({"_screen": screen, "_target": F.coalesce(target, F.lit(""))})
    texts = asked.select(F.explode(F.array("_screen", "_target")).alias("text")).distinct()
    read = resolved(texts, taxonomy)
    of = lambda side: read.select(F.col("text").alias(f"_{side}"), F.struct("section", "object", "operation", "generic", "bare").alias(side))
    both = asked.join(of("screen"), "_screen").join(of("target"), "_target")

    place = lambda hit, strength: F.struct(hit["value"].alias("family"), hit["module"].alias("module"), hit["phrase"].alias("phrase"), strength.alias("strength"))
    found = lambda side: F.when(F.col(f"{side}.section").isNotNull(), place(F.col(f"{side}.section"), F.when(F.col(f"{side}.section.slot") == "strong", "strong").otherwise("weak")))
    container = F.struct(F.lit("chrome").alias("family"), F.lit("container").alias("module"), F.lit("container only").alias("phrase"), F.lit("weak").alias("strength"))
    named = (F.trim("_screen") != "") & ~F.startswith("_screen", F.lit("<"))
    both = both.withColumns({"_around": F.when(named, F.coalesce(found("screen"), F.when(F.col("screen.bare"), container))), "_own": F.when(~F.col("target.generic"), found("target"))})
    both = both.withColumn("_view", F.coalesce(view, F.lit(False)))

    def slot(name: str, value: Column, weight: Column | str, source: str, phrase: Column | str) -> Column:
        as_lit = lambda x: F.lit(x) if isinstance(x, str) else x
        full = F.struct(F.lit(name).alias("slot"), value.alias("value"), as_lit(weight).alias("weight"), F.lit(source).alias("source"), F.replace(as_lit(phrase), F.lit(" "), F.lit("_")).alias("phrase"))
        return F.when(value.isNotNull(), full)

    general = lambda c: F.when(c == GENERAL, "module_general").otherwise("module_specific")
    spoken = lambda x, source: (slot("family", F.col(f"{x}.family"), F.concat(F.lit("family_"), f"{x}.strength"), source, F.col(f"{x}.phrase")), slot("module", F.col(f"{x}.module"), general(F.col(f"{x}.module")), source, F.col(f"{x}.phrase")))
    inherited = lambda name, value: slot(name, value, f"{name}_inherited", "context", "screen_context")
    matched = lambda name, side: slot(name, F.col(f"{side}.{name}.value"), f"{name}_matched", side, F.col(f"{side}.{name}.phrase"))
    around_object = F.when(F.col("_around").isNotNull(), F.col("screen.object.value"))
    slots = {
        "family": F.when(F.col("_view"), spoken("_around", "screen")[0]).otherwise(F.coalesce(spoken("_own", "target")[0], inherited("family", F.col("_around.family")))),
        "module": F.when(F.col("_view"), spoken("_around", "screen")[1]).otherwise(F.coalesce(spoken("_own", "target")[1], inherited("module", F.col("_around.module")))),
        "object": F.when(F.col("_view"), matched("object", "screen")).otherwise(F.coalesce(F.when(~F.col("target.generic"), matched("object", "target")), inherited("object", around_object))),
        "operation": F.when(F.col("_view"), F.coalesce(matched("operation", "screen"), slot("operation", F.lit("view"), "operation_default", "screen", "event_type"))).otherwise(matched("operation", "target")),
    }
    filled = both.withColumns({f"_{k}": v for k, v in slots.items()}).withColumn("_slots", F.when(F.col("_family").isNotNull(), F.array_compact(F.array(*(f"_{k}" for k in slots)))))
    weights = F.create_map(*(F.lit(x) for kv in WEIGHTS.items() for x in kv))
    stages = F.create_map(*(F.lit(x) for kv in taxonomy.stages.items() for x in kv)) if taxonomy.stages else F.create_map().cast("map<string,string>")
    worth = lambda c: F.when(F.col("_slots").isNotNull(), F.coalesce(F.col(f"_{c}.value"), F.lit(UNKNOWN))).otherwise(UNKNOWN)
    score = F.aggregate("_slots", F.lit(0.0), lambda sum_, x: sum_ + F.element_at(weights, x["weight"]))
    told = F.array_join(F.transform("_slots", lambda x: F.concat(x["slot"], F.lit("="), x["value"], F.lit("<-"), x["source"], F.lit(":"), x["phrase"])), ";")
    stage = F.when(F.col("_slots").isNotNull(), F.coalesce(F.try_element_at(stages, worth("operation")), F.lit(UNKNOWN))).otherwise(UNKNOWN)
    sure = F.when(F.col("_slots").isNotNull(), F.round(F.least(score, F.lit(1.0)), 3)).otherwise(0.0)
    values = [worth("family"), worth("module"), worth("object"), worth("operation"), stage, sure, F.coalesce(told, F.lit(""))]
    known = filled.select(*(F.col(k).alias(f"_{k}") for k in keys), *(v.alias(c) for c, v in zip(COLUMNS, values)))
    same = events["event_type"].eqNullSafe(known["_event_type"]) & events["screen_context"].eqNullSafe(known["_screen_context"]) & events["segment_name"].eqNullSafe(known["_segment_name"])
    return events.join(known, same, "left").drop(*(f"_{k}" for k in keys))


def token_ladder(labelled: DataFrame) -> DataFrame:
    """``labelled`` with tokens of four resolutions beside event_token: L3, L2, L1 and the operation."""
    path = lambda *cs: F.concat_ws("/", *cs)
    family, module, thing, operation = "business_family", "business_module", "business_object", "operation"
    return labelled.withColumns({"token_l3": path(family, module, thing, operation), "token_l2": path(family, module), "token_l1": F.col(family), "token_operation": F.concat_ws(":", "operation_stage", operation)})


def level_column(level: str) -> str:
    """The column of a level of tokens; ValueError for an unknown one."""
    if (found := LEVELS.get(str(level).upper())) is None:
        raise ValueError(f"unknown token level {level!r}, expected one of {sorted(LEVELS)}")
    return found


def channel_column(channel: str, primary: str = "EXACT") -> str:
    """The column of a channel, ``primary`` naming the level of the primary one; ValueError for an unknown one."""
    name = str(channel).lower()
    if name == "primary":
        return level_column(primary)
    if name not in CHANNELS:
        raise ValueError(f"unknown token channel {channel!r}, expected one of {['primary', *sorted(CHANNELS)]}")
    return CHANNELS[name]


def channels_from_sequences(rows: DataFrame, key: str, sequence: str, channels: tuple[str, ...], taxonomy: Taxonomy) -> DataFrame:
    """``rows`` with a sequence for each of ``channels``, named as they are, made anew from exact tokens (``event_type@screen#target``).

    Each distinct token is labelled once. Tokens of another make-up (rare marks, coarser forms) stay as they are.
    """
    names = {c: channel_column(c) for c in channels}
    tokens = rows.select(F.explode(F.array_distinct(sequence)).alias("event_token")).distinct()
    kind, rest = F.substring_index("event_token", "@", 1), F.regexp_extract("event_token", r"^[^@]*@(.*)$", 1)
    exact = F.contains(F.col("event_token"), F.lit("@")) & kind.isin("view", "action")
    parts = tokens.where(exact).select("event_token", kind.alias("event_type"), F.substring_index(rest, "#", 1).alias("screen_context"), F.regexp_extract(rest, r"#(.*)$", 1).alias("segment_name"))
    known = token_ladder(annotate(parts, taxonomy)).select(F.col("event_token").alias("token"), F.struct(*(F.col(c).alias(n) for n, c in names.items())).alias("value"))
    found = vocabulary.map_tokens(rows, key, sequence, known)
    each = lambda n: F.transform(sequence, lambda t: F.coalesce(F.try_element_at("_map", t)[n], t))
    return rows.join(found, key).withColumns({n: each(n) for n in names}).drop("_map")


def coverage(labelled: DataFrame) -> DataFrame:
    """One row: events, shares with each part known, mean confidence."""
    known = lambda c: F.round(F.avg((F.col(c) != UNKNOWN).cast("int")), 6).alias(f"known_{c}")
    return labelled.agg(F.count("*").alias("events"), *map(known, COLUMNS[:5]), F.round(F.avg("semantic_confidence"), 6).alias("mean_confidence"))


def review_queue(labelled: DataFrame, n: int = 25) -> DataFrame:
    """The most frequent events without a family."""
    rows = labelled.where(F.col("business_family") == UNKNOWN).groupBy("event_type", "screen_context", "segment_name").agg(F.count("*").alias("events"))
    return rows.orderBy(F.col("events").desc(), "event_type", "screen_context", "segment_name").limit(n)


#: A small taxonomy for the generic event table: its screens and types of action.
EVENT_TABLE = Taxonomy(
    strong={"k0": ("home", GENERAL), "k1": ("shop", "catalog"), "k2": ("shop", "basket"), "purchase": ("payment", "checkout"), "signup": ("account", "registration")},
    weak={"k3": ("support", GENERAL)}, objects={"k1": "product", "purchase": "order"}, operations={"purchase": "pay", "signup": "register", "click": "select", "scroll": "browse"},
    stages={"view": "entry", "pay": "commit", "register": "commit", "select": "browse", "browse": "browse"}, generic=frozenset({"click", "scroll"}),
)
