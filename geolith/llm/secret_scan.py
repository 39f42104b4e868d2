"""Secret scans by assignment-aware lexing.

The lexer of `lexing` reads source and configuration: assignments with and without types, subscripts, elements and
attributes, blocks of lines, strings over several lines, calls that set a name, joined strings, and what comments and
strings hold. A value that is another name takes that name's literals, wherever in the text they are assigned. A literal's
score is how sensitive the most telling name is that it reaches, times how random the literal looks.
Base patterns (assignments by keyword, access keys, long hex) are found besides and always stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Mapping
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.llm.kernels import blocks, joined, runs
from geolith.llm.lexing import read_assignments
from geolith.llm.shared import documents, ready

KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the same as runs of 32 or more
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32

#: Parts of names and how sensitive they make what is assigned to them.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.95, "passphrase": 1.0, "pass": 0.7, "secret": 1.0, "token": 0.95, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "cred": 0.8, "creds": 0.8,
    "auth": 0.75, "authorization": 0.85, "bearer": 0.9, "jwt": 0.85, "cookie": 0.6, "session": 0.6, "private": 0.7, "signature": 0.6, "salt": 0.6, "pin": 0.5, "otp": 0.6, "dsn": 0.7, "webhook": 0.7,
}
#: A "key" is sensitive beside one of these.
KEY_KINDS = {"api", "access", "secret", "private", "auth", "encryption", "signing", "ssh", "master", "service", "client", "account", "storage", "license", "deploy"}
#: Values that stand for a secret but are none.
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|changeme|change[_-]?me|example|sample|test(?:ing)?|dummy|none|null|nil|true|false|undefined|todo|placeholder|your[_-].*|<.*>|\$\(.*\)|\{\{.*\}\}|%\(.*\)s|secret|password|token)$")
REPORT, LEAST = 0.5, 8
#: Words of a passphrase at most; more are prose.
WORDS = 12


def name_score(name: str) -> float:
    """How sensitive a name is, from its parts."""
    parts = [p.lower() for p in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", name)]
    score = max((SENSITIVE.get(p, 0.0) for p in parts), default=0.0)
    if ("key" in parts or "keys" in parts) and KEY_KINDS & set(parts):
        score = max(score, 0.9)
    return max(score, SENSITIVE["apikey"] if "apikey" in "".join(parts) else 0.0)


def phrase(value: str, name: str) -> bool:
    """Whether several words may be a secret: one of them mixes letters and digits, or the name ends in "passphrase" and they are no message."""
    words = value.split()
    mixed = any(re.search(r"[A-Za-z]\d|\d[A-Za-z]", w) for w in words)
    return len(words) <= WORDS and (mixed or (re.search(r"(?i)pass_?phrase$", name) is not None and len(words) > 2 and value[-1] not in ".!?:" and not any(name_score(w) for w in words)))


def literal_score(value: str, name: str = "") -> float:
    """How much a literal that `name` takes looks like a secret: its entropy, over what its length allows. Sensitive names are none."""
    if len(value) < LEAST or PLACEHOLDER.match(value) or (re.fullmatch(r"[A-Za-z][A-Za-z_.-]*", value) and name_score(value) > 0) or len(set(value)) < 5:
        return 0.0
    if re.search(r"\s", value) and not phrase(value, name):
        return 0.0
    n = len(value)
    bits = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, 0.7 * bits / min(math.log2(n), 4.5) + 0.1 * kinds)


def base_spans(text: str, has: tuple[bool, bool, bool]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns; has says which kinds are worth trying."""
    out = []
    if has[0]:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if has[1]:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    if has[2]:
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def reachable(literals: Iterable[str], flows: Mapping[str, set[str]]) -> dict[str, tuple[float, str]]:
    """Of each name: the score and name of the most sensitive name that its value reaches, in time linear in `flows`."""
    sources: dict[str, set[str]] = defaultdict(set)
    for source, targets in flows.items():
        for target in targets:
            sources[target].add(source)
    reach: dict[str, tuple[float, str]] = {}
    for score, target in sorted(((name_score(t), t) for t in {*literals, *sources}), reverse=True):
        front = [target] if score > 0 else []
        while front:
            if (name := front.pop()) not in reach:
                reach[name] = score, target
                front += sources.get(name, ())
    return reach


def assigned_literals(text: str) -> list[tuple[int, int, float, str]]:
    """(start, end, score, name) of literals that reach a sensitive name and look like secrets."""
    found = read_assignments(text)
    best: dict[tuple[int, int], tuple[float, str]] = {}
    reach = reachable(found.literals, found.flows)
    assigned = found.literals.keys() | {target for targets in found.flows.values() for target in targets}  # a bare value of these is no literal
    for name, literals in found.literals.items():
        score, target = reach.get(name, (0.0, ""))
        for a, b, value in literals if score > 0 else ():
            if value not in assigned and (s := score * literal_score(value, target)) >= REPORT:
                best[a, b] = max(best.get((a, b), (0.0, "")), (s, target))
    return sorted((a, b, *v) for (a, b), v in best.items())


#: Without one of these no name is sensitive, and without one of ASSIGNS nothing is assigned.
HINTS = ("pass", "pwd", "secret", "token", "key", "cred", "auth", "bearer", "jwt", "cookie", "session", "private", "signature", "salt", "pin", "otp", "dsn", "webhook")
ASSIGNS = ("=", ":", "<-", "--", "</", "define", "ENV", "setenv", "(")


def may_assign(text: str) -> bool:
    low = text.lower()
    return any(h in low for h in HINTS) and any(a in text for a in ASSIGNS)


def scan(text: str, has: tuple[bool, bool, bool]) -> tuple:
    """The columns after doc_id, and the secrets."""
    base = base_spans(text, has)
    starts, reaches = [a for a, _, _ in base], list(accumulate((b for _, _, b in base), max))
    inside = lambda a, b: (k := bisect_right(starts, a)) > 0 and reaches[k - 1] >= b
    added = [x for x in (assigned_literals(text) if may_assign(text) else []) if not inside(x[0], x[1])]
    n = Counter(kind for _, kind, _ in base)
    write = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
    whole = write(sorted([*base, *((a, 3, b) for a, b, _, _ in added)]))
    secrets = [{"kind": KINDS[k], "start": a, "end": b, "name": None, "score": None} for a, k, b in base] + [{"kind": KINDS[3], "start": a, "end": b, "name": name, "score": s} for a, b, s, name in added]
    return n[0], n[1], n[2], hashlib.sha256(write(base).encode()).hexdigest(), whole, len(added), secrets


OUTPUT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long, secrets array<struct<kind:string,start:long,end:long,name:string,score:double>>"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_literal", pa.int64()),
    ("secrets", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())]))),
])
_HEX = np.zeros(256, bool)
_HEX[[*range(48, 58), *range(97, 103)]] = True


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Base and added spans of each row's whole text, in code points with the end exclusive; see OUTPUT.

    Null text counts as empty: no spans, and the digest of an empty string. Added spans inside a base span are left
    out. Repeated and null doc_ids keep their rows. A very long text is read whole, in time linear in its length.
    Other columns are ignored.
    """
    ready(docs.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, whole = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            for first, texts in blocks(whole):
                data, begin, _ = joined(texts)
                starts, ends = runs(_HEX[data])
                hexed = set((np.searchsorted(begin, starts[ends - starts >= HEX_LEAST], side="right") - 1).tolist())
                rows = []
                for k, raw in enumerate(texts):
                    low = raw.lower()
                    keyed = (b"=" in raw or b":" in raw) and any(w in low for w in (b"passw", b"secret", b"token", b"api"))
                    rows.append((ids[first + k], *scan(whole[first + k] or "", (keyed, b"AKIA" in raw, k in hexed))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(read, OUTPUT)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir)).drop("secrets")
