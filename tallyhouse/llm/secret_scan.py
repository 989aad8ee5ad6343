"""Secret scans by assignment-aware lexing.

Three fixed patterns find the base spans. Beside them, a small lexer reads what looks like source or configuration (``name = "literal"``,
``"name": "literal"``, ``name: literal``, ``name = other + "literal"``, ``name = other or "literal"``, ``name = call("literal")``) into
names and the alternatives they are bound to. Constants are propagated over the whole text, whichever comes first: a literal counts
under every name it is handed on to, and a name within a join stands for its literal. A literal is scored by how sensitive its names
are and how random it looks. Every step takes time in proportion to the text.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import ROWS_AT_ONCE, by_batch

KINDS = ("assign", "access", "hex", "literal")


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


NAMES = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + either_case("api") + "_?" + either_case("key")
ASSIGN = re.compile(rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # whole runs, as [0-9a-f]+ finds them, without the short ones

#: A name with the sign that binds it.
PAIR = re.compile(r"""(?<![\w.-])["']?(?P<name>[A-Za-z_][\w.-]*+)["']?[\x20\t]*+(?::=|=>|[:=](?![:=~]))[\x20\t]*+""")
QUOTED = r"""(?:"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|`[^`\n]*+`)"""
#: What is bound: a quoted literal, a name that a call, a default or a quote joined to it follows, or one bare word.
TERM = re.compile(
    rf"""(?P<quoted>{QUOTED})|(?P<name>[A-Za-z_][\w.]*+(?=\(|[\x20\t]*+(?:\|\||\?\?)|\+["'`]))|(?P<bare>[^\s"'`,;<>(){{}}\[\]]+)"""
)
CALL = re.compile(rf"""\((?:{QUOTED}|[^()"'`\n]|\((?:{QUOTED}|[^()"'`\n])*+\))*+\)""")
ARGUMENT = re.compile(rf"""(?<=[(,])[\x20\t]*+(?:(?P<quoted>{QUOTED})|(?P<name>[A-Za-z_][\w.]*+))(?=[\x20\t]*+[,)])""")
JOIN = re.compile(r"""(?P<plus>[\x20\t]*\+[\x20\t]*(?=["'`])|[\x20\t]+\+[\x20\t]+)|[\x20\t]*(?:\|\||\?\?)[\x20\t]*|[\x20\t]+or[\x20\t]+""")
NAME = re.compile(r"[A-Za-z_][\w.-]*\Z")
CHAINED = re.compile(r"[\x20\t]*+(?::=|=(?![=~>]))")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

#: How sensitive the parts of a name are.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.6, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "privatekey": 1.0, "accesskey": 0.9, "auth": 0.6, "bearer": 0.8, "signature": 0.5,
    "key": 0.4, "salt": 0.6, "session": 0.4, "cookie": 0.4, "private": 0.4, "access": 0.3, "api": 0.3, "client": 0.2, "encryption": 0.4,
}
#: Parts that say a literal is something else.
HARMLESS = {"public", "name", "id", "url", "uri", "path", "file", "type", "format", "length", "count", "hint", "label", "field", "test", "example"}
PLACEHOLDER = re.compile(r"(?i)change|example|placeholder|your|dummy|sample|redacted|xxxx|\*\*\*|^\$|[{}<>]|^(true|false|none|null|nil|undefined)$")


def name_score(name: str) -> float:
    parts = [p.lower() for p in PART.findall(name)]
    joined = "".join(parts)
    score = sum(SENSITIVE.get(p, 0.0) for p in set(parts)) + sum(
        w for long, w in SENSITIVE.items() if len(long) > 5 and long in joined and long not in parts
    )
    return min(score, 1.0) * (0.4 if HARMLESS & set(parts) else 1.0)


class Shape:
    """What of a literal tells whether it is a key or password; shapes of joined literals add up."""

    __slots__ = ("flawed", "kinds", "characters")

    def __init__(self, text: str = ""):
        self.flawed = bool(text) and (any(c.isspace() for c in text) or PLACEHOLDER.search(text) is not None)
        self.kinds = {k for k, pattern in enumerate(("[0-9]", "[a-z]", "[A-Z]", "[^A-Za-z0-9]")) if re.search(pattern, text)}
        self.characters = Counter(text)

    def add(self, other: Shape) -> None:
        self.flawed |= other.flawed
        self.kinds |= other.kinds
        self.characters.update(other.characters)

    def score(self) -> float:
        """How much it looks like a key or password and not like a word: 0 to 1."""
        n = self.characters.total()
        if n < 8 or self.flawed or 0 not in self.kinds and len(self.kinds) < 3:
            return 0.0
        entropy = -sum(c / n * math.log2(c / n) for c in self.characters.values())
        return min(1.0, entropy / 4.0) * (0.7 + 0.1 * min(len(self.kinds), 3))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans (start, kind, end) of the fixed patterns."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


#: A part of what is bound: a literal's start and end, or a word that may be a name, by its start and end as well.
Part = tuple[bool, int, int]


def expression(text: str, at: int) -> tuple[list[list[Part]], int]:
    """The alternatives of what is bound at ``at``, each the parts it joins, and where to look for the next pair."""
    alternatives: list[list[Part]] = [[]]
    resume = None
    while (m := TERM.match(text, at)) is not None:
        at = m.end()
        if m["quoted"] is not None:
            alternatives[-1].append((True, m.start() + 1, at - 1))
        elif text.startswith("(", at):
            resume = resume or at  # what a call names inside itself is read as pairs too
            call = CALL.match(text, at)
            if call is None:
                break
            for a in ARGUMENT.finditer(text, call.start(), call.end()):
                quoted = a["quoted"] is not None
                start, end = a.span("quoted" if quoted else "name")
                alternatives.append([(quoted, start + quoted, end - quoted)])
            alternatives.append([])
            at = call.end()
        else:
            alternatives[-1].append((False, m.start(), at))
            if NAME.match(m[0]) and CHAINED.match(text, at):
                resume = resume or m.start()  # a = b = "literal"
                break
        join = JOIN.match(text, at)
        if join is None:
            break
        if join["plus"] is None:
            alternatives.append([])
        at = join.end()
    return [a for a in alternatives if a], resume or at


class Bindings:
    """The names bound in a text, what each is bound to, and which binding a name within another one stands for."""

    def __init__(self, text: str):
        self.text = text
        self.names: list[str] = []
        self.alternatives: list[list[list[Part]]] = []
        self.where: defaultdict[str, list[int]] = defaultdict(list)
        at = 0
        while (m := PAIR.search(text, at)) is not None:
            found, at = expression(text, m.end())
            if found:
                self.where[m["name"]].append(len(self.names))
                self.names.append(m["name"])
                self.alternatives.append(found)
        self.shapes: dict[tuple[int, int], Shape] = {}
        self.constants: dict[int, Part | None] = {}

    def bound(self, part: Part, by: int) -> int | None:
        """The binding a word stands for: the last one before binding ``by``, else the first one after it."""
        at = self.where.get(self.text[part[1] : part[2]])
        if part[0] or at is None:
            return None
        before, after = bisect_left(at, by), bisect_right(at, by)
        return at[before - 1] if before else at[after] if after < len(at) else None

    def literal(self, part: Part) -> Part | None:
        """A quoted part, or a bare word that is no plain word."""
        _, start, end = part
        if part[0]:
            return part if start < end else None
        word = self.text[start:end].rstrip(".")
        plain = NAME.match(word) and not re.search("[0-9]", word)
        return (True, start, start + len(word)) if word and not plain else None

    def constant(self, i: int) -> Part | None:
        """The literal that binding ``i`` is, by itself or by the names it is handed on from."""
        seen = []
        found = None
        while i not in self.constants:
            self.constants[i] = None  # a ring of names has no literal
            seen.append(i)
            single = [a[0] for a in self.alternatives[i] if len(a) == 1]
            targets = [self.bound(p, i) for p in single]
            literals = [x for p, t in zip(single, targets, strict=True) if t is None and (x := self.literal(p))]
            onward = next((t for t in targets if t is not None), None)
            if literals or onward is None:
                found = literals[0] if literals else None
                break
            i = onward
        else:
            found = self.constants[i]
        self.constants.update(dict.fromkeys(seen, found))
        return found

    def worth(self, parts: list[Part]) -> float:
        """How much joined literals look like a secret."""
        whole = Shape()
        for _, start, end in parts:
            if (start, end) not in self.shapes:
                self.shapes[start, end] = Shape(self.text[start:end])
            whole.add(self.shapes[start, end])
        return whole.score()

    def secrets(self, least: float) -> set[tuple[int, int]]:
        """The spans of literals that score enough under the most sensitive name they reach."""
        own = [name_score(n) for n in self.names]
        reached: dict[int, float] = {}
        for i in sorted((i for i, w in enumerate(own) if w), key=lambda i: -own[i]):
            going = [i] if i not in reached else []
            while going:  # names are met from the most sensitive one on, so the first to reach a binding decides
                j = going.pop()
                if j not in reached:
                    reached[j] = own[i]
                    going += [t for a in self.alternatives[j] if len(a) == 1 and (t := self.bound(a[0], j)) is not None]
        spans = set()
        for i, sensitive in reached.items():
            for parts in self.alternatives[i]:
                targets = [self.bound(p, i) for p in parts]
                if len(parts) == 1 and targets[0] is not None:
                    continue  # a constant handed on is judged where it is bound
                literals = [self.literal(p) if t is None else self.constant(t) for p, t in zip(parts, targets, strict=True)]
                literals = [x for x in literals if x is not None]
                if literals and self.worth(literals) * sensitive >= least:
                    spans.update((a, b) for _, a, b in literals)
        return spans


def scan(text: str, least: float = 0.55) -> list[tuple[int, int, int]]:
    """All spans (start, kind, end) of one text: the base ones, and literals outside them that score enough."""
    base = base_spans(text)
    if "=" not in text and ":" not in text:
        return base
    covered = sorted((s, e) for s, _, e in base)
    starts = [s for s, _ in covered]
    ends = list(accumulate((e for _, e in covered), max))

    def free(a: int, b: int) -> bool:
        before = bisect_left(starts, b)
        return not before or ends[before - 1] <= a

    more = {(a, 3, b) for a, b in Bindings(text).secrets(least) if free(a, b)}
    return sorted({*base, *more}) if more else base


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_secrets(docs: DataFrame, least: float = 0.55) -> DataFrame:
    """The secret spans of every text of ``docs`` (doc_id, text): doc_id, starts, ends (code points), kinds.

    One row per input row. A null text is an empty one and has no spans; a null doc_id stays null. Texts are
    scanned whole, without a shuffle. Other columns are not read.
    """

    def task():
        def rows(batch: pa.RecordBatch) -> dict:
            found = [scan(x.as_py(), least) for x in batch.column("text")]
            return {
                "doc_id": batch.column("doc_id"),
                "starts": [[s for s, _, _ in f] for f in found],
                "ends": [[e for _, _, e in f] for f in found],
                "kinds": [[KINDS[k] for _, k, _ in f] for f in found],
            }

        return rows

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return by_batch(texts, task, "doc_id long, starts array<long>, ends array<long>, kinds array<string>")


def digests(found: DataFrame) -> DataFrame:
    """Counts per base kind and the span lists of ``find_secrets``."""
    spans = F.arrays_zip("kinds", "starts", "ends")
    text = lambda x: F.concat_ws(":", x["kinds"], x["starts"].cast("string"), x["ends"].cast("string"))
    base = F.filter(spans, lambda x: x["kinds"] != KINDS[3])
    number = lambda kind: F.size(F.filter("kinds", lambda k: k == kind)).cast("long")
    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(F.concat_ws(",", F.transform(base, text)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform(spans, text)).alias("spans"),
    )


def redacted(text: str, least: float = 0.55, mask: str = "[secret]") -> str:
    """The text with every span replaced; spans that overlap are replaced as one."""
    out, done = [], 0
    for start, _, end in scan(text, least):
        if start >= done:
            out += [text[done:start], mask]
        done = max(done, end)
    return "".join([*out, text[done:]]) if out else text


def mask_secrets(docs: DataFrame, least: float = 0.55) -> DataFrame:
    """``docs`` with the secrets of its texts masked and n_chars, if there, counted anew.

    All other columns stay as they are; null texts stay null.
    """

    @F.arrow_udf("string")
    def masked(texts: pa.Array) -> pa.Array:
        parts = [texts.slice(start, ROWS_AT_ONCE) for start in range(0, len(texts), ROWS_AT_ONCE)]
        done = [pa.array([None if t is None else redacted(t, least) for t in part.to_pylist()], pa.string()) for part in parts]
        return pa.concat_arrays(done) if done else pa.array([], pa.string())

    out = docs.withColumn("text", masked("text"))
    if "n_chars" not in docs.columns:
        return out
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", F.coalesce(length, "n_chars"))
