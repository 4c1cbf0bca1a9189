"""Secret scan with assignment-aware lexing.

Three base patterns (assignment with a sensitive word, access key id, long
hex run) are found everywhere. On top, lines with an assignment sign are
lexed as source or configuration: strings, names, operators and bare values.
From the tokens come name-literal pairs: ``name = "x"``, ``"name": "x"``,
``obj["name"] = "x"``, ``name => x``, ``--name=x``, ``<name>x</name>``,
``get("NAME", "x")``. Type annotations, string prefixes, brackets, wrapper
calls and line breaks before a value are passed over; values in triple quotes
and YAML blocks count line by line. A right side may join several terms with
``+``; a
term that is a name stands for the literals assigned to it before in the
same text (constants are propagated, also through further names). A call with
one literal gives its name that value, as setters do (``setPassword("x")``).
Literals are scored by the words in the target's name and by what they look
like; a joined value is also scored as a whole, however short its pieces are.
What is at or over the threshold adds spans of kind ``lexed``, of every piece.

Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import map_batches, table

KINDS = ("assign", "access", "hex", "lexed")
THRESHOLD = 1.0
#: Tokens looked back over for a type annotation; characters of a joined value that are put together to score it.
ANNOTATION, JOINED = 24, 4096

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ that are long enough
_HEX_BYTES = re.compile(rb"[0-9a-f]{24,}")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

_TOKEN = re.compile(r"""
    (?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)
  | (?P<tag><(?P<tagname>[A-Za-z_][\w.-]*)(?:\s[^<>\n]*)?>(?P<tagtext>[^<>\n]+)</)
  | (?P<op>:=|=>|==|!=|<=|>=|=|:(?!//)|\+|,|;|[()\[\]{}])
  | (?P<bare>[^\s"'`,;()\[\]{}=:+]+(?:://[^\s"'`]+)?)
""", re.VERBOSE | re.ASCII)
_NAME = re.compile(r"-{0,2}[A-Za-z_$][\w$]*(?:[.\-][A-Za-z_$][\w$]*)*\Z", re.ASCII)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")

_PREFIX = frozenset("b f r u br rb fr rf B F R U L u8 @ $".split())
_LOOKUP = re.compile(r"(?i)(?:.*[.:])?(?:get\w*|env|environ|lookup|fetch|read\w*|input|require|config)\Z")
_BLOCK = re.compile(r"[:=][ \t]*[|>][+-]?\d?[+-]?[ \t]*\Z")
_SIGNS = ("=", ":=", "=>", ":", ",")

#: What a word in a name says about the literal it is given.
_SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "pass": 0.7, "secret": 1.0, "token": 1.0,
              "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "auth": 0.6, "authorization": 0.8,
              "private": 0.5, "api": 0.4, "access": 0.4, "signing": 0.5, "encryption": 0.5, "client": 0.1, "key": 0.6,
              "jwt": 0.9, "pin": 0.5, "salt": 0.5, "cert": 0.3, "session": 0.4, "cookie": 0.4}
_HARMLESS = {"length", "len", "count", "name", "type", "file", "path", "dir", "url", "uri", "hint", "label", "field",
             "policy", "regex", "pattern", "min", "max", "expiry", "expires", "ttl", "id", "prompt", "format",
             "public", "enabled", "required", "limit", "header", "prefix", "suffix", "version", "algorithm"}
_PLACEHOLDER = re.compile(r"(?i)(?:x+|\*+|\.+|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*\)s|your[_-]?.*|change[_-]?me|example.*|"
                          r"placeholder.*|null|none|true|false|undefined|test|todo|redacted)\Z")


def name_score(name: str) -> float:
    """How much a target's name speaks for a secret."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    score = sum(_SENSITIVE.get(p, 0.0) for p in set(parts))
    return score - 0.8 * len(_HARMLESS.intersection(parts[-1:])) - 0.2 * len(_HARMLESS.intersection(parts[:-1]))


def literal_score(literal: str, quoted: bool) -> float:
    """How much a literal looks like a secret: 0 (a placeholder, too short, a plain word) to 1."""
    if len(literal) < 6 or _PLACEHOLDER.match(literal) or any(c.isspace() for c in literal):
        return 0.0
    counts = Counter(literal)
    n = sum(counts.values())
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    if entropy < 2.0:
        return 0.0
    digits, letters = any(c.isdigit() for c in literal), any(c.isalpha() for c in literal)
    signs = any(not c.isalnum() for c in literal)
    score = 0.4 * (digits and letters) + 0.2 * signs + 0.2 * (len(literal) >= 12) + 0.2 * quoted + 0.1 * (entropy > 3.0)
    return min(1.0, score + 0.2)


def _value(kind: str, text: str, start: int) -> tuple[str, int, int, bool]:
    """(literal, start, end, quoted) of a token."""
    if kind == "string":
        return text[1:-1], start + 1, start + len(text) - 1, True
    text = text.rstrip(".!?")
    return text, start, start + len(text), False


def _statements(text: str) -> Iterator[list[tuple[str, str, int]]]:
    """Tokens (kind, text, start) of every line with a sign, and of the lines its right side goes on over.

    A string in triple quotes and a YAML block are a token of kind "block".
    """
    at, size = 0, len(text)
    unclosed: set[str] = set()

    def lex(lo: int, hi: int, out: list) -> int:
        """Adds the tokens from lo to hi; returns where the line ends, later if a block goes over its end."""
        while True:
            quotes = [(i, q) for q in ('"""', "'''") if q not in unclosed and (i := text.find(q, lo, hi)) >= 0]
            first, quote = min(quotes, default=(hi, ""))
            close = text.find(quote, first + 3) if quote else -1
            if quote and close < 0:
                unclosed.add(quote)
                continue
            for m in _TOKEN.finditer(text, lo, first):
                out.append(("tag", m, m.start()) if m["tag"] else (m.lastgroup, m[0], m.start()))
            if not quote:
                return hi
            out.append(("block", text[first + 3:close], first + 3))
            lo = close + 3
            if lo > hi:
                hi = size if (end := text.find("\n", lo)) < 0 else end

    while at < size:
        end = size if (end := text.find("\n", at)) < 0 else end
        line = text[at:end]
        if ("=" in line or ":" in line or "</" in line or '"' in line and "," in line or '("' in line or "('" in line):
            tokens: list = []
            begin, end = at, lex(at, end, tokens)
            if _BLOCK.search(text, max(begin, end - 64), end):
                indent, lo, hi = len(line) - len(line.lstrip()), end + 1, end
                while lo < size:
                    stop = size if (stop := text.find("\n", lo)) < 0 else stop
                    own = text[lo:stop]
                    if own.strip() and len(own) - len(own.lstrip()) <= indent:
                        break
                    hi, lo = stop, stop + 1
                while tokens and tokens[-1][1] not in (":", "="):
                    tokens.pop()
                tokens.append(("block", text[end + 1:hi], end + 1))
                end = hi
            else:
                # A sign, a join or an opened bracket at the end, or a string after one: the right side goes on.
                depth = before = 0
                while tokens and end < size:
                    depth += sum((t[1] in ("(", "[")) - (t[1] in (")", "]")) for t in tokens[before:] if t[0] == "op")
                    last, stop = tokens[-1], text.find("\n", end + 1)
                    stop = size if stop < 0 else stop
                    more = text[end + 1:stop].lstrip()[:1] in ('"', "'") and (last[0] == "string" or last[1] == ",")
                    if not (last[1] in ("=", ":=", "=>", ":", "+", "(", "[", "\\") or depth > 0 and more):
                        break
                    if last[1] == "\\":
                        tokens.pop()
                    before = len(tokens)
                    blank = not text[end + 1:stop].strip()
                    end = lex(end + 1, stop, tokens)
                    if len(tokens) == before and not blank:
                        break
            yield tokens
        at = end + 1


def _names(tokens: list, k: int) -> Iterator[str]:
    """Names the sign at k gives a value: the one before it, and the one before a type annotation."""
    j = k - 1
    if tokens[j][1] == "]" and j:
        j -= 1
    if tokens[k][1] == "," and not (tokens[j][0] == "string" and j and tokens[j - 1][1] == "("):
        return
    if tokens[j][0] == "string":
        yield tokens[j][1][1:-1]
    elif tokens[j][0] == "bare" and _NAME.match(tokens[j][1]):
        yield tokens[j][1].lstrip("-")
    if tokens[k][1] == "=":
        depth = 0
        for i in range(k - 1, max(0, k - ANNOTATION), -1):
            kind, sign, _ = tokens[i]
            depth += (sign == "]") - (sign == "[")
            if sign == ":" and kind == "op" and not depth:
                if i < k - 1 and tokens[i - 1][0] == "bare" and _NAME.match(tokens[i - 1][1]):
                    yield tokens[i - 1][1]
                return
            if kind != "bare" and sign not in ("[", "]") and not (sign == "," and depth):
                return


class Terms(list):
    """A right side: literals (text, start, end, quoted), and the right sides of the constants in it.

    value: the terms put together, if they make one value (at most JOINED characters); pieces: how many literals that joins.
    """

    value: str | None = None
    pieces = 0

    def settle(self, joined: bool) -> None:
        if joined or len(self) == 1:
            parts = [x.value if isinstance(x, Terms) else x[0] for x in self]
            if None not in parts:
                self.value = "".join(parts)[:JOINED]
                self.pieces = min(2, sum(x.pieces if isinstance(x, Terms) else 1 for x in self))


def _right_side(text: str, tokens: list, i: int, constants: dict) -> Terms:
    """Literals, and the constants that stand for some, from token i on."""
    out = Terms()
    joined = True
    opened: list[str] = []  # brackets and wrapper calls around the terms
    after = tokens[i - 1][2]

    def adjacent(i: int) -> bool:
        return i + 1 < len(tokens) and tokens[i + 1][2] == tokens[i][2] + len(tokens[i][1])

    while i < len(tokens):
        own, word, start = tokens[i]
        if own == "op" and word in ("(", "["):
            opened.append(word)
            i += 1
            continue
        if own == "bare" and word in _PREFIX and i + 1 < len(tokens) and (
                tokens[i + 1][0] == "string" and adjacent(i) or tokens[i + 1][0] == "block"):
            i += 1
            continue
        if own == "bare" and adjacent(i) and tokens[i + 1][1] == "(":
            closes = i + 3 < len(tokens) and tokens[i + 3][1] == ","
            if _LOOKUP.match(word) or closes:  # a look-up's argument is a name; of several, none is the value
                break
            opened.append("call")
            i += 2
            continue
        if own == "block":
            joined = False
            lo = start
            for line in word.split("\n"):
                bare = line.strip()
                if bare:
                    first = lo + line.index(bare)
                    out.append((bare, first, first + len(bare), True))
                lo += len(line) + 1
        elif own == "bare" and word in constants:
            out.append(constants[word])
        elif own in ("string", "bare"):
            value = _value(own, word, start)
            if own == "bare":  # signs inside an unquoted value belong to it, up to the next space
                if not out and "\n" in text[after:start] and i + 1 < len(tokens) and tokens[i + 1][1] in _SIGNS:
                    break  # the next line is an assignment of its own
                while adjacent(i) and (tokens[i + 1][0] == "bare" or not tokens[i + 1][1].strip("=:+")):
                    i += 1
                end = tokens[i][2] + len(tokens[i][1])
                value = _value("bare", text[start:end], start)
            out.append(value)
        else:
            break
        i += 1
        while i < len(tokens) and opened and tokens[i][1] in (")", "]"):
            opened.pop()
            i += 1
        if i < len(tokens) and (tokens[i][1] == "+" or tokens[i][1] == "," and opened and opened[-1] == "["
                                or opened and tokens[i][0] in ("string", "block")):
            joined = joined and tokens[i][1] != ","
            i += tokens[i][0] == "op"
        else:
            break
    out.settle(joined)
    return out


def _setter(tokens: list, k: int) -> str | None:
    """The name of the call whose bracket is at k, if it is told one string and nothing else."""
    own, word, start = tokens[k - 1]
    if (own == "bare" and k + 2 < len(tokens) and tokens[k + 1][0] == "string" and tokens[k + 2][1] == ")"
            and tokens[k][2] == start + len(word) and _NAME.match(word) and not _LOOKUP.match(word)):
        return word
    return None


def pairs(text: str) -> Iterator[tuple[str, Terms]]:
    """(name, right side) of every assignment."""
    constants: dict[str, Terms] = {}
    for tokens in _statements(text):
        for kind, m, _ in tokens:
            if kind == "tag":
                right = Terms([(m["tagtext"], m.start("tagtext"), m.end("tagtext"), True)])
                right.settle(True)
                yield m["tagname"], right
        tokens = [t for t in tokens if t[0] != "tag"]
        for k in range(1, len(tokens) - 1):
            if tokens[k][1] == "(" and tokens[k][0] == "op" and (name := _setter(tokens, k)):
                yield name, _right_side(text, tokens, k + 1, {})
            if tokens[k][0] != "op" or tokens[k][1] not in _SIGNS:
                continue
            names = list(_names(tokens, k))
            right = _right_side(text, tokens, k + 1, constants) if names else []
            if right:
                for name in names:
                    if tokens[k][1] != ",":
                        constants[name] = right
                    yield name, right


def literals_of(text: str) -> Iterator[tuple[float, float, tuple[str, int, int, bool]]]:
    """(score of the most telling name, of the value, literal) of every literal that reaches a sensitive name.

    A literal comes once by what it looks like itself, and once by the best joined value it is a piece of.
    """
    told = [(of_name, right) for name, right in pairs(text) if (of_name := name_score(name)) > 0]

    def once(told: list, value) -> Iterator:
        seen: set[int] = set()
        for of_name, of_whole, right in told:
            todo = [right]
            while todo:
                terms = todo.pop()
                if id(terms) in seen:
                    continue
                seen.add(id(terms))
                for term in terms:
                    if isinstance(term, list):
                        todo.append(term)
                    else:
                        yield of_name, value(term, of_whole), term

    yield from once([(n, 0.0, r) for n, r in sorted(told, key=lambda x: -x[0])], lambda t, _: literal_score(t[0], t[3]))
    whole = [(n, literal_score(r.value, True), r) for n, r in told if r.pieces > 1]
    yield from once(sorted(whole, key=lambda x: -(0.7 * x[0] + 0.6 * x[1]) * (x[1] > 0.3)), lambda _, of_whole: of_whole)


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by start, then kind as in KINDS; a null or empty text has none."""
    if not text:
        return []
    spans = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        spans += [("assign", *m.span(), 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span(), 1.0) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    if _HEX_BYTES.search(text.encode("utf-8")):
        spans += [("hex", *m.span(), 1.0) for m in HEX.finditer(text)]
    if "=" in text or ":" in text or "</" in text or '",' in text or '("' in text or "('" in text:
        lexed: dict[tuple[int, int], float] = {}
        for of_name, of_literal, (_, start, end, _) in literals_of(text):
            score = of_name * 0.7 + of_literal * 0.6
            if of_literal > 0.3 and score >= THRESHOLD:
                lexed[start, end] = max(score, lexed.get((start, end), 0.0))
        spans += [("lexed", s, e, score) for (s, e), score in lexed.items()]
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): one row per row of `docs`; spans: array of (kind, start, end, score)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("score", pa.float64())]))
        for batch in batches:
            rows = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find(t)]
                    for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])

    return map_batches(
        docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, spans array<struct<kind: string, start: long, end: long, score: double>>")


def op6_assignment_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != "lexed")
    return found.select("doc_id", *(count(k) for k in KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), count(KINDS[3]))
