"""Secret scan: plain patterns, and an assignment-aware lexer for what they miss.

The lexer reads source and configuration syntax as name-literal pairs (`name = "x"`,
`name: x`, `name := x`, `name => x`, `<name>x</name>`, `--name x`), follows constants
(`a = "x"` ... `password = a`) and keeps a literal when the score of its target name
and its own shape reaches a threshold. The marks # and // end a pair and no more: what
follows is read on, be it a comment or the rest of a URL. A quote opens a literal after an
operator, and a name where one may stand and an operator follows the closing quote;
any other quote, as in prose, is passed over and what it holds is read on. Spans are code
points, end exclusive. Every search that fails is remembered, so a text takes time in
proportion to its length.

No text is the empty text and has no spans; repeated rows give repeated rows; any
further columns of the input are left out of the result.
"""

import math
import re
from collections import Counter

from pyspark.sql import DataFrame, functions as F

from claimwright.llm.common import map_batches, shielded, utf8

# The base patterns and the least lengths of what they catch.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "literal")

ASSIGN_HINTS = (b"passw", b"secret", b"token", b"api_key", b"apikey")
NAME_SCORES = {
    "password": 4, "passwd": 4, "pwd": 4, "passphrase": 4, "secret": 4, "token": 3,
    "apikey": 4, "credential": 4, "credentials": 4, "private": 2, "access": 1, "auth": 2,
    "api": 1, "key": 2, "signing": 1, "encryption": 1, "bearer": 3, "pass": 2,
}
NAME_HINTS = tuple(n.encode() for n in NAME_SCORES)
THRESHOLD = 5

TOKEN = re.compile(
    r"""(?P<mark>\#|//)
      | (?P<name>--?[A-Za-z][\w.-]*|[A-Za-z_$][\w.$-]*)
      | (?P<quote>["'`])
      | (?P<op>:=|=>|==|!=|<=|>=|=|:)
      | (?P<bare>[0-9+/][\w+/=.-]*)
      | (?P<end>[\n;,{}()\[\]])
      | (?P<other>[^\S\n]+|.)""",
    re.VERBOSE)
QUOTED = {
    '"': re.compile(r'(?:[^"\\\n]|\\.)*+(?=")'), "'": re.compile(r"(?:[^'\\\n]|\\.)*+(?=')"),
    "`": re.compile(r"[^`\n]*+(?=`)")}
OPERATOR = re.compile(r"[^\S\n]*(?::=|=>|=(?!=)|:)")
ELEMENT = re.compile(r"<([A-Za-z_][\w.-]*)>([^<>\n]+)</\1\s*>")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
BARE_VALUE = re.compile(r"[A-Za-z0-9+/_.=~!@#$%^&*-]+")
PLACEHOLDER = re.compile(r"(?i)^(?:\$\{?.*|<.*>|x+|\*+|none|null|true|false|changeme|example.*|your.*)$")


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns, leftmost and not overlapping per kind."""
    found = []
    lowered = raw.lower()
    if any(h in lowered for h in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if b"AKIA" in raw:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def name_score(name: str) -> int:
    """How sensitive a target name is: the sum over its different parts."""
    parts = {p.lower() for p in PARTS.findall(name)}
    return sum(NAME_SCORES.get(p, 0) for p in parts)


def literal_score(value: str) -> int:
    """How much a literal looks like a secret: length, kinds of characters, entropy."""
    if len(value) < ASSIGN_LEAST or " " in value or PLACEHOLDER.match(value):
        return -10
    kinds = sum(bool(re.search(k, value)) for k in ("[a-z]", "[A-Z]", "[0-9]", r"[^\w\s]"))
    counts = Counter(value)
    entropy = -sum(c / len(value) * math.log2(c / len(value)) for c in counts.values())
    return (kinds >= 2) + (kinds >= 3) + (len(value) >= 16) + (entropy >= 3.0)


def pairs(text: str) -> list[tuple[str, str | None, int, int]]:
    """(name, referenced name, start, end) of the literal of every assignment, in order."""
    out = []
    for m in ELEMENT.finditer(text):
        lead = len(m[2]) - len(m[2].lstrip())
        out.append((m[1], None, m.start(2) + lead, m.end(2) - (len(m[2]) - len(m[2].rstrip()))))
    unclosed: dict[str, int] = {}

    def closing(mark: str, at: int):
        """(start, end, what follows) of the literal that a quote opens, if it is closed."""
        three = mark * 3
        if text.startswith(three, at) and unclosed.get(three, -1) <= at:
            end = text.find(three, at + 3)
            if end >= 0:
                return at + 3, end, end + 3
            unclosed[three] = len(text)
        if at < unclosed.get(mark, -1):
            return None
        found = QUOTED[mark].match(text, at + 1)
        if found:
            return at + 1, found.end(), found.end() + 1
        line = text.find("\n", at)
        unclosed[mark] = len(text) if line < 0 else line
        return None

    # `fresh`: a name may stand here, after the start of a line, a bracket or a comma.
    name, armed, fresh, at, run = None, False, True, 0, 0
    while at < len(text):
        m = TOKEN.match(text, at)
        kind, value, start, at = m.lastgroup, m[0], at, m.end()
        if kind == "other":
            if not value.isspace():
                name, armed, fresh = None, False, False
        elif kind in ("end", "mark"):
            name, armed, fresh = None, False, True
        elif kind == "op":
            armed, fresh = name is not None and value in ("=", ":", ":=", "=>"), False
        elif kind == "quote":
            found = closing(value, start) if armed or fresh else None
            if armed and found:
                out.append((name, None, *found[:2]))
                name, armed, fresh, at = None, False, False, found[2]
            elif not armed:
                named = found and OPERATOR.match(text, found[2])
                name, fresh = (text[found[0]:found[1]] if named else None), not named
                at = found[2] if named else at
        elif armed or (name is not None and name.startswith("--")):
            if start >= run:
                whole = BARE_VALUE.match(text, start)
                run = whole.end() if whole else start
            if run > start:
                reference = value if run == at and kind == "name" else None
                out.append((name, reference, start, run))
                # What was given to a sensitive name is one literal; else it may be a name.
                at = run if name_score(name) >= 3 else at
            name, armed, fresh = (value if kind == "name" and at == m.end() else None), False, False
        else:
            name, fresh = (value if kind == "name" else None), False
    return sorted(out, key=lambda p: p[2])


def lexed_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans of literals assigned, directly or through constants, to sensitive names.

    A name that is not itself sensitive holds the last literal given to it; assigning
    it to a sensitive name marks that literal where it stands.
    """
    constants: dict[str, tuple[int, int]] = {}
    scores: dict[tuple[int, int], int] = {}
    found = set()
    for name, reference, start, end in pairs(text):
        seen = reference is not None and reference in constants
        if seen:
            start, end = constants[reference]
        sensitive = name_score(name)
        if sensitive >= 3:
            if (start, end) not in scores:
                scores[start, end] = literal_score(text[start:end])
            # A bare word of letters is prose or a reference, not a literal.
            if sensitive + scores[start, end] >= THRESHOLD and (
                    seen or reference is None
                    or not reference.replace("-", "").replace(".", "").isalpha()):
                found.add((start, 3, end))
        constants[name] = (start, end)
    return sorted(found)


def scan(text: str, raw: bytes) -> tuple[list, list]:
    """The base spans and all spans of one text; a lexed span inside a base one adds nothing."""
    base = base_spans(text, raw)
    lowered = raw.lower()
    if not any(h in lowered for h in NAME_HINTS) or not (
            b"=" in raw or b":" in raw or b"--" in raw or b"</" in raw):
        return base, base
    extra, i, reach = [], 0, 0
    for span in lexed_spans(text):
        while i < len(base) and base[i][0] <= span[0]:
            reach = max(reach, base[i][2])
            i += 1
        if span[2] > reach:
            extra.append(span)
    return base, sorted(base + extra)


def join_spans(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redacted(text: str, spans: list) -> str:
    """The text with every span replaced by a mark that names its kind."""
    out, at = [], 0
    for s, k, e in spans:
        if e <= at:
            continue
        out += [text[at:max(s, at)], f"[{KINDS[k]}]"]
        at = e
    return "".join(out) + text[at:]


def scan_secrets(docs: DataFrame, id_column: str = "doc_id", redact: bool = False,
                 keep: list[str] = ()) -> DataFrame:
    """One row per document: its base counts and spans; with `redact` the masked text too.

    `keep` names columns carried over unchanged.
    """
    keep = [c for c in keep if c not in (id_column, "text")]
    types = dict(docs.dtypes)
    schema = ", ".join([
        f"`{id_column}` {types[id_column]}", "n_assign bigint", "n_access bigint", "n_hex bigint",
        "base string", "spans string", *(["text string"] if redact else []),
        *[f"`{c}` {types[c]}" for c in keep]])

    def work(blocks):
        for block in blocks:
            out = {n: [] for n in ("n_assign", "n_access", "n_hex", "base", "spans", "text")}
            for raw in block["_raw"]:
                text = raw.decode("utf-8", "replace")
                base, spans = scan(text, raw)
                for kind, name in enumerate(("n_assign", "n_access", "n_hex")):
                    out[name].append(sum(k == kind for _, k, _ in base))
                out["base"].append(join_spans(base))
                out["spans"].append(join_spans(spans))
                out["text"].append(redacted(text, spans) if redact and spans else text if redact else None)
            yield {**out, **{c: block[c] for c in (id_column, *keep)}}

    return map_batches(docs.select(id_column, *keep, utf8().alias("_raw")), schema, work)


def without_secrets(docs: DataFrame) -> DataFrame:
    """The documents with every span masked; a null text becomes empty."""
    return shielded(docs, lambda d: scan_secrets(
        d, redact=True, keep=[c for c in d.columns if c not in ("doc_id", "text")]))


def contract(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    return scan_secrets(docs).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")
