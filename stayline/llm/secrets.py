"""Secret scans: plain patterns, and an assignment-aware lexer that scores literals by their targets' names."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from stayline.llm.wordbytes import slices

#: Kinds of spans, in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "literal")
#: A kind's pattern, the group whose length counts, and its least length. Matches that fail are used up.
PATTERNS = (
    (
        "assign",
        re.compile(
            r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
            r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
        ),
        2,
        6,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)

#: Words of a target's name and how far they make its value a secret; the greatest counts.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "pass": 0.9,
    "secret": 1.0, "secrets": 1.0, "credential": 0.9, "credentials": 0.9, "token": 0.9, "bearer": 0.9,
    "apikey": 1.0, "authkey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "privatekey": 1.0, "auth": 0.6,
    "authorization": 0.8, "dsn": 0.6, "salt": 0.6, "pin": 0.5, "key": 0.4, "signature": 0.5,
}
#: Words before "key" that make the two one sensitive word.
KEYS = {"api", "access", "private", "secret", "signing", "encryption", "master", "auth", "account", "shared"}
#: Words that tell of something about a secret, not of the secret.
ABOUT = {
    "public", "length", "len", "count", "size", "name", "file", "path", "dir", "url", "uri", "field", "label", "hint",
    "prompt", "policy", "pattern", "regex", "type", "expires", "expiry", "ttl", "max", "min", "limit", "id", "header",
    "format", "message", "error", "reset", "help", "title",
}
#: Values that stand for one that is not there.
PLACEHOLDER = re.compile(
    r"(?i)\A(?:none|null|nil|true|false|undefined|empty|todo|tbd|change_?-?me|redacted|hidden|dummy|sample"
    r"|example.*|placeholder.*|your[-_ ].*|my[-_ ].*|insert[-_ ].*|enter[-_ ].*|x+|\*+|\.+|-+|_+|<.*>|\$\{.*\}|\$\(.*\)|\{\{.*\}\}|%.*%|%[sd]|\{\w*\})\Z",
    re.S,
)
THRESHOLD = 0.5
OPEN = 200  # characters at a line's end in which an open bracket lets it go on

_SIGN = re.compile(r"[=:]|<[A-Za-z_]|--[A-Za-z]")  # what a line with an assignment has
_GOES_ON = re.compile(r"(?:[=+(\\]|[=:][ \t]*\([^()\n]*)[ \t]*\Z")
_TOKEN = re.compile(
    r"""(?P<string>\"{3}.*?\"{3}|'{3}.*?'{3}|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)"""
    r"""|(?P<tag><(?P<el>[A-Za-z_][\w.-]*)>(?P<body>[^<>\n]*)</(?P=el)\s*>)"""
    r"""|(?P<name>-{0,2}[A-Za-z_$][\w$]*(?:[.-][A-Za-z_$][\w$]*)*)"""
    r"""|(?P<op>:=|=>|==|!=|<=|>=|->|::|//|[-=:+,;()\[\]{}#<>.])"""
    r"""|(?P<other>[^\s"'`,;()\[\]{}=:+#<>]+)"""
    r"""|(?P<quote>["'`])""",
    re.S,
)
_BARE = re.compile(r"[^\s\"'`,;()\[\]{}#<>]+")
_END = re.compile(r"[ \t]*(?:[,;][ \t]*)?(?:(?:#|//)[^\n]*)?(?:\n|\Z)")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


class Pair(NamedTuple):
    """A literal `start`..`end` (code points, without quotes) that reaches the target `name`, and its score."""

    kind: str
    start: int
    end: int
    name: str | None
    score: float


def base_spans(text: str) -> list[Pair]:
    """Leftmost matches of each kind of PATTERNS that do not overlap, less those that are too short."""
    out = []
    for kind, pattern, group, least in PATTERNS:
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append(Pair(kind, m.start(), m.end(), m.group(1) if group else None, 1.0))
    return out


def sensitivity(name: str) -> float:
    """0 to 1: how surely the value of a variable, field or flag of this name is a secret."""
    words = [w.lower() for w in _WORDS.findall(name)]
    best = max((SENSITIVE.get(w, 0.0) for w in words), default=0.0)
    if any(b == "key" and a in KEYS for a, b in zip(words, words[1:])):
        best = 1.0
    return best * 0.3 if ABOUT.intersection(words) else best


@dataclass
class Shape:
    """What a constant's strength is judged by; shapes of joined constants add up without the constant."""

    length: int = 0
    kinds: int = 0  # bits: small letter, capital, digit, other sign, white space
    signs: frozenset = frozenset()

    @classmethod
    def of(cls, value: str) -> Shape:
        signs = frozenset(value)
        kinds = 0
        for c in signs:
            kinds |= 16 if c.isspace() else 1 if c.islower() else 2 if c.isupper() else 4 if c.isdigit() else 8
        return cls(len(value), kinds, signs)

    def __add__(self, other: Shape) -> Shape:
        return Shape(self.length + other.length, self.kinds | other.kinds, self.signs | other.signs)

    def strength(self) -> float:
        """0 to 1, by length, different signs and kinds of signs; words with spaces are most often prose."""
        if self.length < 6 or len(self.signs) < 4:
            return 0.0
        kinds = (self.kinds & 15).bit_count()
        full = 1.0 if kinds >= 3 or (kinds == 2 and self.length >= 8) else 0.7 if self.length >= 12 or kinds == 2 else 0.55
        return full * (0.4 if self.kinds & 16 else 1.0)


@dataclass
class Assignment:
    """`target` gets the joined `terms`: literals (start, end) and names of other targets."""

    target: str
    terms: list = field(default_factory=list)


def _statements(text: str):
    """(start, end) of logical lines that hold an operator; a line that ends open goes on in the next one."""
    at = 0
    while m := _SIGN.search(text, at):
        start = max(at, text.rfind("\n", 0, m.start()) + 1)
        end = _line_end(text, m.start())
        while end < len(text) and _GOES_ON.search(text, max(start, end - OPEN), end):
            end = _line_end(text, end + 1)
        if (close := _open_quotes(text, start, end)) is not None:
            end = close
        yield start, end
        at = end + 1


def _line_end(text: str, at: int) -> int:
    stop = text.find("\n", at)
    return len(text) if stop < 0 else stop


def _open_quotes(text: str, start: int, end: int) -> int | None:
    """Where a literal in three quotes that begins in the line ends, if in a later one: its line's end."""
    for mark in ('"""', "'''"):
        n, at = 0, text.find(mark, start, end)
        while at >= 0:
            n, last = n + 1, at
            at = text.find(mark, at + 3, end)
        if n % 2 and (close := text.find(mark, last + 3)) >= 0:
            return _line_end(text, close)
    return None


def _unquote(m: re.Match) -> tuple[int, int]:
    n = 3 if m.group()[:3] in ('"""', "'''") and len(m.group()) >= 6 else 1
    return m.start() + n, m.end() - n


def _value(tokens: list, k: int, text: str, end: int):
    """The terms of the expression that begins at token `k`, and the token after it."""
    terms = []
    opened = 0
    while k < len(tokens):
        m, kind = tokens[k], tokens[k].lastgroup
        after = tokens[k + 1].group() if k + 1 < len(tokens) else ""
        if kind == "op" and m.group() == "(":
            opened, k = opened + 1, k + 1
            continue
        if kind == "string":
            terms.append(_unquote(m))
        elif kind == "name" and after not in ("(", "["):
            bare = _BARE.match(text, m.start(), end)
            if not terms and _END.match(text, bare.end()):
                last = k
                while last + 1 < len(tokens) and tokens[last + 1].start() < bare.end():
                    last += 1
                # A lone word at the end of its line: another target's name, or a value without quotes.
                terms.append((m.start(), bare.end(), m.group()) if last == k else (m.start(), bare.end()))
                k = last
            elif after in ("+", "=", ",", ";", ")", "]", "}") or k + 1 == len(tokens):
                terms.append(m.group())
            else:
                break
        elif kind == "other" and not terms:
            bare = _BARE.match(text, m.start(), end)
            if not bare or not _END.match(text, bare.end()):
                break
            terms.append((bare.start(), bare.end()))
            while k + 1 < len(tokens) and tokens[k + 1].start() < bare.end():
                k += 1
        else:
            break
        k += 1
        while opened and k < len(tokens) and tokens[k].group() == ")":
            opened, k = opened - 1, k + 1
        if k < len(tokens) and tokens[k].group() == "+":
            k += 1
            continue
        if opened and k < len(tokens) and tokens[k].lastgroup == "string":
            continue  # neighbouring literals in brackets are joined
        break
    return terms, k


def assignments(text: str) -> list[Assignment]:
    """Name-literal pairs and name-name pairs of source and configuration syntax, in order.

    `name = value`, `name := value`, `name: value`, `name: type = value`, `"name": value`, `name => value`,
    `x["name"] = value`, `--name value`, `<name>value</name>`. Values are literals in quotes, names, values
    without quotes up to the line's end, and all of them joined by +.
    """
    out = []
    for start, end in _statements(text):
        tokens = list(_TOKEN.finditer(text, start, end))
        k = 0
        while k < len(tokens):
            m, kind = tokens[k], tokens[k].lastgroup
            if m.group("tag"):
                out.append(Assignment(m.group("el"), [m.span("body")]))
                k += 1
                continue
            if kind not in ("name", "string"):
                k += 1
                continue
            name = m.group() if kind == "name" else text[slice(*_unquote(m))]
            at = k + 1
            if kind == "string" and at < len(tokens) and tokens[at].group() == "]":
                at += 1
            op = tokens[at].group() if at < len(tokens) else ""
            if op == ":" and at + 2 < len(tokens) and tokens[at + 1].lastgroup == "name" and tokens[at + 2].group() == "=":
                # A type between, or a label before.
                name = max(name, tokens[at + 1].group(), key=sensitivity)
                at, op = at + 2, "="
            if op in ("=", ":", ":=", "=>"):
                terms, after = _value(tokens, at + 1, text, end)
                if terms:
                    out.append(Assignment(name, terms))
                # A value may be a target too: a = b = "c".
                k = max(at + 1, after - 1) if terms and isinstance(terms[-1], str) else max(at + 1, after)
                continue
            if name.startswith("--") and at < len(tokens) and tokens[at].lastgroup in ("string", "name", "other"):
                bare = None if tokens[at].lastgroup == "string" else _BARE.match(text, tokens[at].start(), end)
                out.append(Assignment(name, [bare.span() if bare else _unquote(tokens[at])]))
            k += 1
    return out


def literal_pairs(text: str) -> list[Pair]:
    """Each literal with the most sensitive target that it reaches, as constants are passed on and joined.

    Sensitivity goes from a target to all names that its value is made of, to any depth (most sensitive
    first, so every name is settled once); a literal is judged by itself and by what it is joined to.
    """
    found = assignments(text)
    if not found:
        return []
    defined: dict[str, list[Assignment]] = {}
    for a in found:
        defined.setdefault(a.target, []).append(a)
    for a in found:
        a.terms = [(t[2] if t[2] in defined and t[2] != a.target else t[:2]) if isinstance(t, tuple) and len(t) == 3 else t for t in a.terms]
    level = {name: (sensitivity(name), name) for name in defined}
    settled: set[str] = set()
    bands = sorted({s for s, _ in level.values() if s > 0}, reverse=True)
    for band in bands:
        todo = [n for n in defined if level[n][0] == band and n not in settled]
        while todo:
            name = todo.pop()
            if name in settled:
                continue
            settled.add(name)
            for a in defined[name]:
                for t in a.terms:
                    if isinstance(t, str) and t in defined and t not in settled:
                        if level[name][0] > level[t][0]:
                            level[t] = level[name]
                        if level[t][0] == band:
                            todo.append(t)
    if not settled:
        return []
    shapes: dict[str, Shape] = {}

    def shape_of(name: str) -> Shape:
        """The joined shape of a target's first value; names are followed without recursion, cycles count once."""
        stack = [(name, False)]
        open_: set[str] = set()
        while stack:
            n, ready = stack.pop()
            if n in shapes or (n in open_ and not ready):
                continue
            terms = defined[n][0].terms
            if not ready:
                open_.add(n)
                stack.append((n, True))
                stack += [(t, False) for t in terms if isinstance(t, str) and t in defined]
                continue
            total = Shape()
            for t in terms:
                total = total + (Shape.of(text[t[0] : t[1]]) if isinstance(t, tuple) else shapes.get(t, Shape()))
            shapes[n] = total
        return shapes[name]

    # What a name's value is joined to counts for its literals too.
    joined: dict[str, float] = {}
    for a in found:
        if len(a.terms) > 1 and level[a.target][0] > 0:
            total = Shape()
            for t in a.terms:
                total = total + (Shape.of(text[t[0] : t[1]]) if isinstance(t, tuple) else shape_of(t) if t in defined else Shape())
            for t in a.terms:
                if isinstance(t, str):
                    joined[t] = max(joined.get(t, 0.0), level[a.target][0] * total.strength())
    best: dict[tuple[int, int], Pair] = {}
    for a in found:
        sense, by = level[a.target]
        if not sense:
            continue
        whole = Shape()
        for t in a.terms:
            whole = whole + (Shape.of(text[t[0] : t[1]]) if isinstance(t, tuple) else shapes.get(t) or Shape())
        for t in a.terms:
            if not isinstance(t, tuple) or t[0] == t[1] or PLACEHOLDER.match(text[t[0] : t[1]]):
                continue
            score = max(sense * whole.strength(), joined.get(a.target, 0.0))
            if t not in best or best[t].score < score:
                best[t] = Pair("literal", t[0], t[1], by, score)
    return sorted(best.values(), key=lambda p: p.start)


def spans(text: str | None, threshold: float = THRESHOLD) -> list[Pair]:
    """All base spans, and the literals that score `threshold` or more and overlap none of them."""
    if not text:
        return []
    found = base_spans(text)
    taken = sorted((p.start, p.end) for p in found)
    at = 0
    upto = -1  # the furthest end of the base spans that begin before the literal's end
    for p in literal_pairs(text):
        while at < len(taken) and taken[at][0] < p.end:
            upto = max(upto, taken[at][1])
            at += 1
        if p.score >= threshold and upto <= p.start:
            found.append(p)
    return sorted(found, key=lambda p: (p.start, KINDS.index(p.kind), p.end))


def scan(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD, keep_text: bool = False) -> DataFrame:
    """All columns of `docs` (the text on demand) and `found`: an array of (kind, start, end, name, score), by
    start, then kind as in KINDS; places in code points.

    Base spans come from PATTERNS. The lexer adds `literal` spans: it reads each text's assignments, passes
    constants on from name to name, and scores a literal by the most sensitive name it reaches and by its own
    shape. Every text is scanned whole and on its own, so nothing is shuffled. NULL and empty texts have an empty
    array; repeated rows are scanned alike; a column named found is replaced.
    """
    rest = [c for c in docs.columns if (keep_text or c != text) and c != "found"]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    fields = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())]

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                rows = [[p._asdict() for p in spans(t, threshold)] for t in part.column(text).to_pylist()]
                found = pa.array(rows, pa.list_(pa.struct(fields)))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in rest], found], names=[*rest, "found"])

    ddl = ", ".join(
        [f"`{c}` {kinds[c]}" for c in rest]
        + ["found array<struct<kind:string,start:bigint,end:bigint,name:string,score:double>>"]
    )
    return docs.select(*[f"`{c}`" for c in dict.fromkeys([*rest, text])]).mapInArrow(run, ddl)
